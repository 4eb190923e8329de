"""Insight tables over the prepared base table (I1-I7). Every output is grouped by label,
so results are bounded by labels x categories."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.columns import safe_ratio

# Metrics averaged per label in the studied workflow (fixed list).
LABEL_METRICS = ["order_processing_time", "delivery_speed_days", "delivery_accuracy_days",
                 "Shipping_Cost_Percentage", "order_payment_value", "nbr_installments"]


def label_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def avg_by_label(df: DataFrame, metrics: Sequence[str] = LABEL_METRICS) -> DataFrame:
    return df.groupBy("label").agg(*[F.avg(m).alias(f"avg_{m}") for m in metrics])


def label_gap(df: DataFrame) -> DataFrame:
    """avg(label 0) - avg(label 1) in one pass; processing time reported in hours."""
    def gap(c):
        return F.avg(F.when(F.col("label") == 0, F.col(c))) - F.avg(F.when(F.col("label") == 1, F.col(c)))
    return df.agg((gap("order_processing_time") / 60).alias("processing_time_gap_hours"),
                  gap("delivery_speed_days").alias("delivery_speed_gap_days"),
                  gap("delivery_accuracy_days").alias("delivery_accuracy_gap_days"))


def status_by_label(df: DataFrame) -> DataFrame:
    return (df.groupBy("label", "order_status").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("label"), F.col("n").desc(), F.col("order_status")))


def top_statuses(df: DataFrame, k: int = 2) -> DataFrame:
    """The k most frequent statuses (ties broken by status name)."""
    return (df.groupBy("order_status").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("order_status")).limit(k))


def payment_type_share(df: DataFrame, payments: DataFrame) -> DataFrame:
    """Share of payment rows per type within each label; an order without payment rows
    counts once with a null type. Percent of the label total, rounded to 2 places."""
    j = df.select("order_id", "label").join(payments.select("order_id", "payment_type"), "order_id", "left")
    counts = j.groupBy("label", "payment_type").agg(F.count(F.lit(1)).alias("n"))
    # counts has labels x types rows, so the per-label window is small
    total = F.sum("n").over(Window.partitionBy("label"))
    return (counts.select("label", "payment_type", "n",
                          F.round(safe_ratio(F.col("n").cast("double"), total.cast("double")) * 100, 2).alias("percentage"))
            .orderBy(F.col("label").desc(), F.col("percentage").desc()))


def with_products(df: DataFrame) -> DataFrame:
    """Rows whose order has at least one item with a known product (the I5/I6 population)."""
    return df.where(F.col("n_product_items") > 0)


def product_info_by_label(df: DataFrame) -> DataFrame:
    return with_products(df).groupBy("label").agg(
        F.round(F.avg("avg_prod_name_lenght"), 2).alias("avg_prod_name_lenght"),
        F.round(F.avg("avg_prod_description_lenght"), 2).alias("avg_prod_description_lenght"),
        F.round(F.avg("avg_product_photos_qty"), 2).alias("avg_product_photos_qty"))


def feature_label_corr(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson correlation of each feature with the label, one aggregate for all; a
    constant feature gives null instead of a division error. Sorted descending."""
    pop = with_products(df)
    y = F.col("label").cast("double")
    aggs = []
    for c in features:
        x = F.col(c).cast("double")
        aggs.append(safe_ratio(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias(c))
    row = pop.agg(*aggs)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation")) for c in features])
    return row.select(F.explode(cells).alias("c")).select("c.*").orderBy(F.col("correlation").desc_nulls_last())
