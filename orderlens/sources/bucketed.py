"""Tables kept in buckets of their order id, so that joins and aggregates by order need no shuffle."""

from __future__ import annotations

import uuid
from typing import Optional

from pyspark.sql import DataFrame, SparkSession

from orderlens.session import scratch_path
from orderlens.sources.files import Tables

#: The tables that are keyed by order.
BY_ORDER = ("orders", "items", "payments", "reviews")


def bucketed(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table of ``buckets`` buckets, sorted in each, and read it back. The
    files lie in the shared folder; the table's name is this session's."""
    spark: SparkSession = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (df.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", scratch_path(spark, f"bucketed-{name}"))
     .saveAsTable(table))
    return spark.table(table)


def bucket_by_order(tables: Tables, buckets: Optional[int] = None) -> Tables:
    """The table set with its order-keyed tables in buckets (as many as the session shuffles to).

    One shuffle per table, once; every later job over them joins and groups by order where the
    rows lie. Products stay as they are.
    """
    spark = tables.orders.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = {name: bucketed(getattr(tables, name).repartition(n, "order_id"), "order_id", n, name)
            for name in BY_ORDER if getattr(tables, name) is not None}
    return Tables(products=tables.products, **kept)
