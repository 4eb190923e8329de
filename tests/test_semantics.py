"""Hand-made frames for the null, tie and boundary rules of the studied workflow."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.operators import metrics, reviews
from orderlens.operators.features import basetable, in_window, item_aggregates, payment_aggregates, time_features
from orderlens.operators.prep import MeanImputer, WinsorizerModel
from orderlens.sources.schemas import ITEMS, ORDERS, PAYMENTS, PRODUCTS, REVIEWS

T0 = dt.datetime(2022, 1, 1, 0, 0, 0)


def _reviews(spark, rows):
    return spark.createDataFrame(rows, REVIEWS)


def test_latest_review_keeps_ties_and_drops_null_times(spark):
    r = _reviews(spark, [
        ("r1", "o1", 5, T0, T0), ("r2", "o1", 1, T0, T0),          # tie on the latest time
        ("r3", "o1", 3, T0, T0 - dt.timedelta(days=1)),              # older
        ("r4", "o2", 4, T0, None),                                   # only review, null time
    ])
    got = sorted(r.id for r in reviews.latest_reviews(r).select(F.col("review_id").alias("id")).collect())
    assert got == ["r1", "r2"]


def test_review_on_two_orders_is_dropped(spark):
    r = _reviews(spark, [("r1", "o1", 5, T0, T0), ("r1", "o2", 5, T0, T0), ("r2", "o3", 2, T0, T0)])
    got = [x.review_id for x in reviews.dedupe_reviews(r).collect()]
    assert got == ["r2"]


def test_null_score_labels_zero(spark):
    f = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    r = spark.createDataFrame([("o1", None), ("o2", 4)], "order_id string, review_score int")
    got = {x.order_id: x.label for x in basetable(f, r).collect()}
    assert got == {"o1": 0.0, "o2": 1.0}


def test_zero_price_and_shipping_gives_null_share(spark):
    items = spark.createDataFrame([("o1", 1, "p1", 0.0, 0.0)], ITEMS)
    prods = spark.createDataFrame([], PRODUCTS)
    row = item_aggregates(items, prods).first()
    assert row.Shipping_Cost_Percentage is None
    assert row.total_product_category is None  # no known product: null, not 0
    assert row.order_item_count == 1


def test_payment_counts_and_sets(spark):
    p = spark.createDataFrame([("o1", "card", 3, 10.0), ("o1", "card", 1, 5.0), ("o1", "voucher", 1, 1.0)], PAYMENTS)
    row = payment_aggregates(p).first()
    assert row.nbr_payments_used == 2 and row.payment_types == ["card", "voucher"] and row.nbr_installments == 3


def test_last_day_window(spark):
    o = spark.createDataFrame([("o1", "c", "F", dt.datetime(2022, 6, 30, 10, 0), None, None, None, T0),
                               ("o2", "c", "F", dt.datetime(2022, 6, 30, 0, 0), None, None, None, T0)], ORDERS)
    assert {r.order_id for r in in_window(o, "2022-01-01", "2022-06-30").collect()} == {"o2"}
    assert {r.order_id for r in in_window(o, "2022-01-01", "2022-06-30", end_inclusive_day=True).collect()} == {"o1", "o2"}


def test_sub_second_times_floor_each_side(spark):
    o = spark.createDataFrame([("o1", "c", "F", dt.datetime(2022, 1, 1, 0, 0, 0, 900000),
                                dt.datetime(2022, 1, 1, 0, 0, 2, 100000), None, None, T0)], ORDERS)
    row = time_features(o).first()
    assert row.order_processing_time == pytest.approx(2 / 60)


def test_int_mean_fill_truncates(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "x int")
    imp = MeanImputer(["x"]).fit(df)  # mean 1.666..
    assert [r.x for r in imp.transform(df).collect()] == [1, 2, 2, 1]
    imp2 = MeanImputer(["x"], int_mode="double").fit(df)
    assert imp2.transform(df).collect()[3].x == pytest.approx(5 / 3)


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (0.5,), (9.0,)], "x double")
    w = WinsorizerModel({"x": (0.0, 1.0)})
    assert [r.x for r in w.transform(df).collect()] == [None, 0.0, 0.5, 1.0]


def test_single_class_auc_and_roc_null(spark):
    df = spark.createDataFrame([(1.0, 0.3), (1.0, 0.7)], "label double, probability double")
    assert metrics.auc(df).first().auc is None
    assert all(r.fpr is None for r in metrics.roc_curve(df).collect())


def test_auc_matches_rank_statistic(spark):
    rows = [(1.0, 0.9), (0.0, 0.8), (1.0, 0.8), (0.0, 0.1), (1.0, 0.4), (0.0, 0.4)]
    df = spark.createDataFrame(rows, "label double, probability double")
    pos = [s for l, s in rows if l == 1]
    neg = [s for l, s in rows if l == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert metrics.auc(df, block_rows=2).first().auc == pytest.approx(want)


def test_weighted_f1_matches_mllib(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0), (2.0, 2.0), (2.0, 1.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    want = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert metrics.weighted_f1(df).first().weighted_f1 == pytest.approx(want)
