"""Binding of the driver's TPC-H-style test tables to the five logical tables.

The test tables carry no e-commerce lifecycle, so this adapter derives one with
modulus rules (nulls included) that are fixed: the DuckDB oracle in
``orderlens.plans.oracle`` derives the same views from the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.files import Tables


_TABLES: dict = {}


def listing(spark: SparkSession, sf_dir: str, *names: str) -> tuple:
    """(file, bytes, time of change) of the tables' files: what is remembered for an input goes with it."""
    out = []
    for name in names:
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        files = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
        out += sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files)
    return tuple(out)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one test table. The handle (schema and file listing, no data) is
    reused within a session while the files are the same, so composing many queries does not
    re-read footers."""
    key, files = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name), listing(spark, sf_dir, name)
    if key not in _TABLES or _TABLES[key][0] != files:
        _TABLES[key] = (files, spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))
    return _TABLES[key][1]


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def bind_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    return o.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        day.alias("order_purchase_timestamp"),
        _null_when(key % 97 == 0, F.timestamp_add("MINUTE", key % 2880, day)).alias("order_approved_at"),
        _null_when(key % 31 == 0, F.timestamp_add("HOUR", key * 7 % 960, day)).alias("order_delivered_customer_date"),
        F.timestamp_add("DAY", 10 + F.col("o_custkey") % 20, day).alias("order_estimated_delivery_date"),
    )


def bind_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("shipping_cost"),
    )


def bind_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    return li.where(F.col("l_quantity") > 10).select(
        F.col("l_orderkey").alias("order_id"),
        F.concat("l_returnflag", "l_linestatus").alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("payment_value"),
    )


def bind_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        _null_when(F.col("p_partkey") % 50 == 0, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length(F.concat("p_name", "p_brand", "p_type")).alias("product_description_lenght"),
        (size % 6).alias("product_photos_qty"),
        (size * 100).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (size % 10 + 1).alias("product_height_cm"),
        (size % 7 + 1).alias("product_width_cm"),
    )


def bind_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    return li.where(F.col("l_discount") <= 0.05).select(
        (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        (F.col("l_quantity").cast("int") % 5 + 1).alias("review_score"),
        _null_when(F.col("l_linenumber") == 7, F.col("l_shipdate")).alias("review_answer_timestamp"),
    )


def bind_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        orders=bind_orders(spark, sf_dir),
        items=bind_items(spark, sf_dir),
        payments=bind_payments(spark, sf_dir),
        products=bind_products(spark, sf_dir),
        reviews=bind_reviews(spark, sf_dir),
    )


def bind_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in model output over every bound order, for metric operators.

    label, probability and prediction are pure functions of an md5 bucket of the key.
    """
    o = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"))
    bucket = F.conv(F.substring(F.md5(F.col("order_id").cast("string")), 1, 8), 16, 10).cast("bigint") % 10000
    o = o.select("order_id", bucket.alias("bucket"))
    return o.select(
        "order_id",
        F.when((F.col("order_id") * 7919) % 10000 < F.col("bucket"), 1.0).otherwise(0.0).alias("label"),
        (F.col("bucket") / F.lit(10000.0)).alias("probability"),
        F.when(F.col("bucket") > 5000, 1.0).otherwise(0.0).alias("prediction"),
    )
