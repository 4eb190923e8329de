"""Mergeable sketches in place of exact order statistics and distinct counts.

Sketches of fixed size are kept per group (a month, say) and merged for any set of groups, so
bounds over a longer span need no second look at the rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: KLL size: ranks are within about ``2.3 / K^0.9021`` of all rows (0.13 %).
K = 4000
RANK_ERROR = 2.296 / K ** 0.9021
#: HLL registers are 2^LG_K; distinct counts are within about 1.04 / sqrt(2^LG_K) (one standard error).
LG_K = 14
COUNT_ERROR = 1.04 / 2 ** (LG_K / 2)


def quantile_sketches(df: DataFrame, columns: Sequence[str], group: Sequence[str], k: int = K) -> DataFrame:
    """``group`` and one KLL sketch per column: a partially combined aggregate of fixed-size states."""
    return df.groupBy(*group).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(c) for c in columns])


def merged_quantiles(sketches: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict:
    """{column: [value near each prob]} over all rows of ``sketches``; None for a column without values."""
    merged = sketches.agg(*[F.kll_merge_agg_double(c).alias(c) for c in columns])
    row = merged.select(*[F.when(F.kll_sketch_get_n_double(c) > 0, F.array(
        *[F.kll_sketch_get_quantile_double(F.col(c), F.lit(p)) for p in probs])).alias(c) for c in columns]).first()
    return {c: list(row[c]) if row[c] else [None for _ in probs] for c in columns}


def rank_within(column: str, value: float, prob: float, error: float = RANK_ERROR) -> Column:
    """Whether ``value``'s ranks (from below and with ties) come within ``error`` of ``prob``: a column for an aggregate."""
    n = F.count(column)
    below, upto = F.count_if(F.col(column) < value), F.count_if(F.col(column) <= value)
    return ((below - 1) / n <= F.lit(prob + error)) & ((upto + 1) / n >= F.lit(prob - error))


def distinct_sketches(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """``group`` and one HLL sketch of the distinct non-null values per column, in one aggregate without Expand."""
    return df.groupBy(*group).agg(*[F.hll_sketch_agg(F.col(c), F.lit(LG_K)).alias(c) for c in columns])


def distinct_estimates(sketches: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct counts per ``group``, of the union of its sketches."""
    merged = sketches.groupBy(*group).agg(*[F.hll_union_agg(c).alias(c) for c in columns])
    return merged.select(*group, *[F.hll_sketch_estimate(c).alias(c) for c in columns])

