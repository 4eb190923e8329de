"""Review dedupe: keep each order's latest review(s), then drop reviews that span orders.

Step one is an aggregate followed by a semi join back to the reviews, keyed on (order_id,
timestamp), which spreads a hot order across partitions. Step two alone is the same, split by
AQE skew handling; on the latest reviews it is one aggregate. Aggregates are partially combined
map-side, so a hot order or review id never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.operators.sketches import distinct_estimates, distinct_sketches

ORDER_SCORES = "order_scores"


def latest_reviews(reviews: DataFrame, order_col: str = "order_id",
                   ts_col: str = "review_answer_timestamp") -> DataFrame:
    """Rows whose answer time equals the order's maximum. Ties all survive; rows with a
    null time (or null order) never do."""
    latest = (reviews.where(F.col(order_col).isNotNull() & F.col(ts_col).isNotNull())
              .groupBy(order_col).agg(F.max(ts_col).alias(ts_col)))
    return reviews.join(latest, on=[order_col, ts_col], how="left_semi")


def unique_reviews(reviews: DataFrame, review_col: str = "review_id",
                   order_col: str = "order_id") -> DataFrame:
    """Rows whose review id occurs at most once (counting non-null orders)."""
    keep = (reviews.groupBy(review_col).agg(F.count(order_col).alias("_n"))
            .where((F.col("_n") <= 1) & F.col(review_col).isNotNull())
            .select(review_col))
    return reviews.join(keep, on=review_col, how="left_semi")


def dedupe_reviews(reviews: DataFrame, review_col: str = "review_id") -> DataFrame:
    """``unique_reviews`` of the ``latest_reviews``, which are found once.

    Every latest review has an order, so a review id that counts one order is one row, and that
    row's values are its group's: one aggregate, without a join back to the reviews."""
    latest = latest_reviews(reviews).where(F.col(review_col).isNotNull())
    rest = [c for c in latest.columns if c != review_col]
    return (latest.groupBy(review_col).agg(F.count(F.lit(1)).alias("_n"), *[F.first(f"`{c}`").alias(c) for c in rest])
            .where(F.col("_n") == 1).drop("_n"))


def with_order_scores(reviews: DataFrame) -> DataFrame:
    """``reviews`` with all scores of their order (tied latest reviews), each in a struct that keeps a null."""
    return reviews.withColumn(ORDER_SCORES, F.collect_list(F.struct("review_score")).over(Window.partitionBy("order_id")))


def review_cardinality(reviews: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct orders and reviews before dedupe, after the latest filter, after the unique filter.

    ``approx`` estimates them from HLL sketches of fixed size (``orderlens.operators.sketches``),
    which need no shuffle of the ids."""
    latest = latest_reviews(reviews)
    unique = unique_reviews(latest)

    def card(df: DataFrame, stage: str) -> DataFrame:
        if approx:
            found = distinct_estimates(distinct_sketches(df, ["order_id", "review_id"]), ["order_id", "review_id"])
            found = found.withColumnsRenamed({"order_id": "n_orders", "review_id": "n_reviews"})
        else:
            found = df.agg(F.count_distinct("order_id").alias("n_orders"), F.count_distinct("review_id").alias("n_reviews"))
        return found.select(F.lit(stage).alias("stage"), "n_orders", "n_reviews")

    return card(reviews, "raw").unionByName(card(latest, "latest")).unionByName(card(unique, "unique"))
