"""Rules that hold at any size: exact means, the price check, null scores, unseen levels, scratch folders."""

import math
from types import SimpleNamespace

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderlens.operators import encode, metrics
from orderlens.operators.features import customer_value, in_window, item_aggregates, order_features, payment_aggregates
from orderlens.operators.quality import price_invariant
from orderlens.plans.params import SCORE_END, SCORE_START, W_END, W_START
from orderlens.plans.workflow import unseen
from orderlens.session import ensure_checkpoint_dir
from orderlens.sources.binding import bind_tables
from tests.conftest import SF

ITEMS = "order_id long, order_item_id int, product_id long, price double, shipping_cost double"
PRODUCTS = ("product_id long, product_category_name string, product_name_lenght int, product_description_lenght int, product_photos_qty int, "
            "product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int")


@pytest.mark.parametrize("amounts, mean", [([4e-7, 4e-7], 4e-7), ([1e13, 3e13], 2e13), ([1.0, float("nan")], float("nan")), ([None, 5.0], 5.0)])
def test_customer_mean_of_any_amount(spark, amounts, mean):
    orders = spark.createDataFrame([(i, 7) for i in range(len(amounts))], "order_id long, customer_id long")
    payments = spark.createDataFrame([(i, "A", 1, x) for i, x in enumerate(amounts)],
                                     "order_id long, payment_type string, payment_installments int, payment_value double")
    got = customer_value(orders, payment_aggregates(payments)).first()
    assert got["avg_cust_value"] == pytest.approx(mean, nan_ok=True) and math.isnan(got["avg_cust_value"]) == math.isnan(mean)
    assert got["Num_orders"] == len(amounts)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, 1, 10, 5.0, 1.0), (1, 2, 10, 5.0, 1.0), (1, 3, 11, 2.0, 0.0), (2, 1, 99, 1.0, 0.0), (2, 2, None, 4.0, 0.0)], ITEMS)


def test_item_features_of_repeated_and_unknown_products(spark, items):
    products = spark.createDataFrame([(10, "a", 4, 8, 1, 100, 1, 2, 3), (11, "b", 10, 20, None, 50, 1, 1, 1)], PRODUCTS)
    rows = {r["order_id"]: r for r in item_aggregates(items, products).collect()}
    one, two = rows[1], rows[2]
    assert (one["total_item_price"], one["order_price"], one["order_item_count"], one["order_diversity"]) == (12.0, 12.0, 3, 2)
    assert (one["n_product_items"], one["total_product_category"], one["order_volume_cm3"], one["order_weight_kg"]) == (3, 2, 13, 0.25)
    assert (one["avg_prod_name_lenght"], one["avg_prod_description_lenght"], one["avg_product_photos_qty"]) == (6.0, 12.0, 1.0)
    assert (two["total_item_price"], two["order_diversity"], two["n_product_items"], two["total_product_category"]) == (5.0, 1, 0, None)
    assert two["order_volume_cm3"] is None and two["avg_prod_name_lenght"] is None


def test_price_check_finds_a_duplicated_product(spark, items):
    products = spark.createDataFrame([(10, "a", 4, 8, 1, 100, 1, 2, 3)] * 2 + [(11, "b", 1, 2, 1, 50, 1, 1, 1)], PRODUCTS)
    aggregated = item_aggregates(items, products)
    assert {r["check"] for r in price_invariant(aggregated).collect()} == {True, False}
    assert {r["order_id"]: r["total_item_price"] for r in aggregated.collect()} == {1: 12.0, 2: 5.0}


def test_items_are_scanned_once_without_expand(spark):
    t = bind_tables(spark, SF)
    plan = item_aggregates(t.items, t.products)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("lineitem.parquet") == 1
    assert "Expand" not in order_features(t)._jdf.queryExecution().executedPlan().toString()


def test_null_labels_and_scores_say_nothing(spark):
    rows = [(1.0, 0.9), (0.0, 0.1), (1.0, 0.4), (0.0, 0.5), (None, 0.95), (1.0, None)]
    df = spark.createDataFrame(rows, "label double, probability double")
    assert metrics.auc(df).first()["auc"] == pytest.approx(0.75)
    assert metrics.roc_curve(df).count() == 4


@pytest.mark.parametrize("block_rows", [1, 7, 10_000])
def test_auc_does_not_depend_on_blocks(spark, block_rows):
    df = spark.range(500).select(((F.col("id") * 37 % 101) / 101.0).alias("probability"), (F.col("id") * 53 % 7 > 3).cast("double").alias("label"))
    rows = [(r["probability"], r["label"]) for r in df.collect()]
    good, bad = [p for p, y in rows if y], [p for p, y in rows if not y]
    expected = sum((p > q) + 0.5 * (p == q) for p in good for q in bad) / (len(good) * len(bad))
    assert metrics.auc(df, block_rows=block_rows).first()["auc"] == pytest.approx(expected)


def test_unseen_status_is_the_zero_vector(spark):
    train = spark.createDataFrame([("F",), ("O",), ("P",)], "order_status string")
    model = Pipeline(stages=encode.status_encoder()).fit(train)
    out = model.transform(spark.createDataFrame([("P",), ("new",)], "order_status string"))
    assert [r["v"] for r in out.select(vector_to_array(encode.STATUS_VEC).alias("v")).collect()] == [[0.0, 0.0, 1.0], [0.0, 0.0, 0.0]]


def test_a_cluster_needs_a_shared_folder():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def test_csv_intake_counts_what_does_not_fit(spark, tmp_path):
    from orderlens.sources.files import corrupt_records, read_csv
    from orderlens.sources.schemas import ORDERS
    path = tmp_path / "orders.csv"
    path.write_text(",".join(ORDERS.names) + "\n"
                    "a,c,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,,2017-10-10 21:25:13,2017-10-18 00:00:00\n"
                    "b,c,delivered,yesterday,,,,2017-10-18 00:00:00\n"
                    "c,d,shipped,2017-10-02 10:56:33,,,,,one,too,many\n")
    rows = read_csv(spark, str(path), ORDERS, keep_corrupt=True)
    got = {r["order_id"]: r for r in rows.collect()}
    assert got["a"]["order_approved_at"].isoformat() == "2017-10-02T11:07:15" and got["b"]["order_purchase_timestamp"] is None
    assert corrupt_records(rows) == 1 and got["c"]["_corrupt_record"].startswith("c,d")


def test_class_weights_balance_classes(spark):
    from orderlens.operators.train import WEIGHT, with_class_weights
    df = with_class_weights(spark.createDataFrame([(1.0,)] * 6 + [(2.0,)] * 2, "label double"))
    assert {r["label"]: r["w"] for r in df.groupBy("label").agg(F.sum(WEIGHT).alias("w")).collect()} == {1.0: 4.0, 2.0: 4.0}


def test_a_window_shuffles_the_items_of_its_orders_only(spark):
    tables = bind_tables(spark, SF)
    few = order_features(tables, W_START, W_END, write_payments=False)
    assert "LeftSemi" in few._jdf.queryExecution().optimizedPlan().toString()
    every = order_features(tables, write_payments=False).join(in_window(tables.orders, W_START, W_END).select("order_id"), "order_id", "left_semi")
    key = lambda df: sorted(((r["order_id"], r["order_item_count"], r["total_product_category"], r["n_product_items"], r["order_weight_kg"]) for r in df.collect()), key=str)
    assert key(few) == key(every)


def test_the_unseen_window_holds_the_rows_of_its_orders_only(spark):
    whole = bind_tables(spark, SF)
    part = unseen(whole, SCORE_START, SCORE_END)
    ids = {r[0] for r in part.orders.select("order_id").collect()}
    for rows, full in ((part.items, whole.items), (part.payments, whole.payments)):
        seen = [r[0] for r in rows.select("order_id").collect()]
        assert set(seen) <= ids and len(seen) == sum(r[0] in ids for r in full.select("order_id").collect()) < full.count()
