"""Forests are grown on few partitions, whatever the number that the rows come in."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from orderlens.operators.train import in_forest_partitions, rf


@pytest.fixture(scope="module")
def scattered(spark):
    rows = spark.range(0, 600, 1, 24).select(F.col("id").alias("order_id"), (F.col("id") % 7).cast("double").alias("a"),
                                             (F.col("id") * 37 % 101).cast("double").alias("b"), (F.col("id") % 7 > F.col("id") * 53 % 11).cast("double").alias("label"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)


@pytest.mark.parametrize("size, parts", [(20_000, 1), (100, 6), (1, 24)])
def test_no_more_partitions_than_the_rows_need(scattered, size, parts):
    few = in_forest_partitions(scattered, size)
    assert few.rdd.getNumPartitions() == parts
    assert sorted(r["order_id"] for r in few.select("order_id").collect()) == list(range(600))


def test_an_empty_table_keeps_its_columns(scattered):
    assert in_forest_partitions(scattered.where("a < 0")).count() == 0


def test_a_forest_is_grown_on_few_partitions(scattered):
    params = {"numTrees": 3, "maxDepth": 4}
    assert rf(params).fit(scattered).toDebugString.splitlines()[1:] == rf(params).fit(scattered.coalesce(1)).toDebugString.splitlines()[1:]
