"""What the feature build shared by the model queries may shuffle: the window's rows, and each table once."""

import datetime as dt

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from orderlens.operators import reviews as R
from orderlens.operators.features import customer_value, maybe_of_orders, of_orders, order_features, payment_aggregates, payment_totals
from orderlens.operators.prep import TEST, TRAIN, VALIDATION, only
from orderlens.plans.modelling import _binary
from orderlens.plans.params import W_END, W_START
from orderlens.plans.workflow import Workflow
from orderlens.sources.binding import bind_tables
from tests.conftest import SF

T0 = dt.datetime(2018, 1, 1)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("kind", ["long", "string"])
def test_the_bitmap_keeps_every_row_of_the_orders_and_few_others(spark, kind):
    rows = spark.range(20_000).select((F.col("id") % 10_000).cast(kind).alias("order_id"), F.col("id").alias("x"))
    orders = spark.range(0, 10_000, 10).select(F.col("id").cast(kind).alias("order_id")).unionByName(spark.createDataFrame([(None,)], f"order_id {kind}"))
    kept = maybe_of_orders(rows, orders)
    assert kept.columns == rows.columns and 2_000 <= kept.count() < 2_100
    assert sorted(of_orders(kept, orders).collect()) == sorted(of_orders(rows, orders).collect())
    other = orders.select(F.col("order_id").cast("double").alias("order_id"))
    assert maybe_of_orders(rows, other).count() == 20_000  # equal ids of other types may hash apart


def test_the_exact_join_is_not_moved_before_the_bitmap(spark):
    tables = bind_tables(spark, SF)
    text = plan(of_orders(maybe_of_orders(tables.items, tables.orders), tables.orders))
    exact, sift = (next(i for i, line in enumerate(text.splitlines()) if "LeftSemi" in line and what in line) for what in ("order_id", "__row"))
    assert exact < sift  # the outer join stands above


def test_a_window_writes_no_payments_of_other_orders(spark):
    features = order_features(bind_tables(spark, SF), W_START, W_END)
    assert not any("order-payments" in f for f in features.inputFiles())
    assert plan(features).count("collect_set(payment_type") == 1


def test_customer_value_from_totals(spark):
    t = bind_tables(spark, SF)
    one, two = ({r[0]: (r[2], r[1]) for r in customer_value(t.orders, f(t.payments)).collect()} for f in (payment_totals, payment_aggregates))
    assert one.keys() == two.keys() and all(one[k][0] == two[k][0] and one[k][1] == pytest.approx(two[k][1]) for k in one)


REVIEWS = "review_id string, order_id string, review_score int, review_answer_timestamp timestamp"


def test_deduping_reads_the_latest_reviews_once(spark):
    rows = [("a", "o1", 5, T0), ("b", "o1", None, T0), ("c", "o2", 1, T0), ("c", "o3", 2, T0), (None, "o4", 3, T0),
            ("d", "o5", 1, T0), ("d", "o5", 1, T0), ("e", "o6", 4, None), ("f", None, 4, T0), ("g", "o7", 2, T0), ("g", "o7", 1, T0 - dt.timedelta(1))]
    r = spark.createDataFrame(rows, REVIEWS)
    apart = R.unique_reviews(R.latest_reviews(r))
    assert R.dedupe_reviews(r).columns == apart.columns
    assert sorted(R.dedupe_reviews(r).collect(), key=str) == sorted(apart.collect(), key=str)
    assert {x["review_id"] for x in apart.collect()} == {"a", "b", "g"}
    assert plan(R.dedupe_reviews(bind_tables(spark, SF).reviews)).count("Relation") == 2


def test_five_class_rows_need_no_join(spark):
    t = bind_tables(spark, SF)
    # every order's reviews twice over: two tied ones, one of them without a score
    late = F.lit(dt.datetime(2030, 1, 1))
    ids = t.orders.select("order_id")
    tied = ids.select(F.col("order_id").alias("review_id"), "order_id", (F.col("order_id") % 5 + 1).cast("int").alias("review_score"),
                      late.alias("review_answer_timestamp"))
    more = tied.withColumns({"review_id": -F.col("review_id") - 1, "review_score": F.when(F.col("order_id") % 3 > 0, F.lit(2))})
    t.reviews = tied.unionByName(more)
    wf = Workflow(spark, t, W_START, W_END)
    rows = wf.multiclass(TRAIN)
    assert "Join" not in plan(rows)
    scores = R.dedupe_reviews(t.reviews).select("order_id", F.col("review_score").cast("double").alias("label"))
    joined = wf.split(TRAIN).select("order_id", "features").join(scores, "order_id")
    key = lambda df: sorted((r["order_id"], str(r["label"])) for r in df.collect())
    assert key(rows) == key(joined) and len(key(rows)) == 2 * wf.split(TRAIN).count() > 0


def test_a_split_is_chosen_before_its_rows_are_encoded(spark):
    wf = Workflow(spark, bind_tables(spark, SF), W_START, W_END)
    for name in (TRAIN, TEST, VALIDATION):
        lines = plan(wf.split(name)).splitlines()
        chosen = next(i for i, line in enumerate(lines) if "Filter" in line and f"= {name})" in line)
        assert not any("UDF(" in line for line in lines[chosen:])  # the encoder's functions stand above
        whole = only(wf.assembled(), name).select("order_id", "features", "label")
        assert sorted(wf.split(name).collect(), key=str) == sorted(whole.collect(), key=str)


class Splits:
    def __init__(self, rows):
        self.rows = rows

    def split(self, name):
        return self.rows.where(F.col("part") == name).drop("part")


def test_the_test_split_is_scored_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def probability(i):
        seen.add(i >= 200)
        return i % 10 / 10

    class Model:
        def transform(self, df):
            p = df.withColumn("p", probability("order_id"))
            return p.withColumns({"probability": array_to_vector(F.array(1 - F.col("p"), "p")), "prediction": F.round("p")}).drop("p")

        def fit(self, train):
            return self
    part = F.when(F.col("id") < 100, TRAIN).when(F.col("id") < 200, VALIDATION).otherwise(TEST)
    rows = spark.range(300).select(F.col("id").alias("order_id"), (F.col("id") % 10 > 5).cast("double").alias("label"), part.alias("part"))
    sel, measures = _binary(Splits(rows), lambda p: Model(), [{}])
    assert sel.metric == 1.0 and measures["test_auc"] == 1.0 and measures["test_accuracy"] == 0.9  # a half rounds to 1
    assert seen.value == 100
