"""Counts that come with the write of the split base, CSV line counts, and what the feature build scans."""

import pytest
from pyspark.sql import functions as F

from orderlens.operators import quality, reviews
from orderlens.operators.audit import audited_split_base
from orderlens.operators.features import item_aggregates, order_features
from orderlens.sources.binding import bind_tables
from orderlens.sources.files import Tables, read_tables, write_csv
from orderlens.sources.schemas import SCHEMAS
from tests.conftest import SF
from tests.test_scale_rules import ITEMS, PRODUCTS


@pytest.mark.parametrize("window", [("1996-09-01", "1998-06-30"), (None, None), ("2090-01-01", "2091-01-01")])
def test_audit_equals_plain_aggregates(spark, window):
    t = bind_tables(spark, SF)
    base, audit = audited_split_base(t, reviews.dedupe_reviews(t.reviews), *window)
    features = order_features(t, *window)
    assert audit.rows == features.count()
    assert audit.nulls == {r["column_name"]: r["n_null"] for r in quality.null_audit(features).collect()}
    plain = {r["check"] for r in quality.price_invariant(features).collect()}
    assert {r["check"] for r in audit.check_frame(spark).collect()} == plain
    sizes = {r["split"]: r["count"] for r in base.groupBy("split").count().collect()}
    assert {r["split"]: r["n"] for r in audit.split_frame(spark).collect()} == sizes


def test_csv_tables_count_their_lines_as_they_are_read(spark, tmp_path):
    for name, schema in SCHEMAS.items():
        write_csv(spark.createDataFrame([], schema), str(tmp_path / f"{name}.csv"))
    orders = tmp_path / "plain"
    orders.mkdir()
    names = SCHEMAS["orders"].names
    (orders / "orders.csv").write_text(",".join(names) + "\n" + "a,c,delivered,2017-10-02 10:56:33,,,,\n" + "b,d,shipped,,,,,,one,too,many\n")
    for name in SCHEMAS:
        if name != "orders":
            (orders / f"{name}.csv").write_text(",".join(SCHEMAS[name].names) + "\n")
    counters = {}
    tables = read_tables(spark, str(orders), counters=counters)
    assert isinstance(tables, Tables) and "_corrupt_record" not in tables.orders.columns
    assert {r["order_id"] for r in tables.orders.collect()} == {"a", "b"}
    assert (counters["orders"].get["corrupt"], counters["orders"].get["rows"]) == (1, 2)


def test_feature_build_has_no_window_and_reads_items_and_payments_once(spark):
    t = bind_tables(spark, SF)
    plan = order_features(t)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("lineitem.parquet") == 1 and plan.count("order-payments") >= 1
    assert plan.count("orders.parquet") <= 2


def test_items_without_an_order_and_shared_products(spark):
    items = spark.createDataFrame([(None, 1, 10, 5.0, 1.0), (None, 2, 10, 5.0, 1.0), (1, 1, 10, 3.0, 1.0), (1, 2, 11, 4.0, 1.0)], ITEMS)
    products = spark.createDataFrame([(10, "a", 4, 8, 1, 100, 1, 2, 3), (10, "b", None, 8, 1, 100, 1, 2, 3), (11, "a", 1, 2, 1, 50, 1, 1, 1),
                                      (None, "z", 1, 1, 1, 1, 1, 1, 1)], PRODUCTS)
    row, = item_aggregates(items, products).collect()
    assert (row["order_id"], row["total_item_price"], row["order_price"], row["order_diversity"]) == (1, 7.0, 10.0, 2)
    assert (row["n_product_items"], row["total_product_category"], row["order_volume_cm3"]) == (3, 2, 13)
    assert row["avg_prod_name_lenght"] == pytest.approx(2.5) and row["avg_prod_description_lenght"] == pytest.approx(6.0)


def test_rewritten_inputs_are_read_again(spark, tmp_path):
    from orderlens.plans.modelling import _once
    from orderlens.sources.binding import bind_orders
    for name in ("orders", "lineitem", "part"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(20).write.parquet(str(tmp_path / f"{name}.parquet"))
    made = []
    def once():
        return _once(spark, str(tmp_path), "test", lambda: made.append(1) or len(made))
    assert (once(), once(), bind_orders(spark, str(tmp_path)).count()) == (1, 1, 20)
    spark.read.parquet(f"{SF}/orders.parquet").limit(7).write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
    assert (once(), bind_orders(spark, str(tmp_path)).count()) == (2, 7)


def test_scratch_folders_go_with_their_scope(spark):
    import os
    from orderlens.sources.files import materialize, scratch_scope
    with scratch_scope(spark):
        some = materialize(spark.range(5), "some")
        with scratch_scope(spark):
            inner = materialize(some.where("id > 1"), "inner")
            result = materialize(inner.selectExpr("id * 2 as id"), "result", kept=True)
        folders = [os.path.dirname(df.inputFiles()[0].removeprefix("file://").removeprefix("file:")) for df in (some, result)]
        assert all(map(os.path.exists, folders)) and not os.path.exists(os.path.dirname(inner.inputFiles()[0].removeprefix("file://")))
    assert [os.path.exists(x) for x in folders] == [False, True] and sorted(r["id"] for r in result.collect()) == [4, 6, 8]
