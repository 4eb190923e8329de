"""Exact percentiles (``percentile_cont`` semantics) by distributed selection.

Spark's exact ``percentile`` aggregate keeps a value -> count map per group, which for
a continuous column grows with the data. Here, for all columns together and alike at every
size:

1. rows are reduced to distinct values with their counts (a partially combined aggregate,
   so a dominant value is one row from each task), written once;
2. these are written in ranges of about ``range_values`` values in the order of (column,
   value), and the rows of each range are added up;
3. the ranges that hold the wanted ranks follow from the sums before them; only their
   values are put in order, one window per range, and the values at the ranks are returned.

The driver sees a count per column and the values asked for; no task ever ranks more than a range.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.operators.ranges import RANGE, in_ranges, totals_before
from orderlens.sources.files import materialize


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """cid, v, n: how often each non-null value occurs in each column."""
    cells = F.array(*[F.struct(F.lit(i).alias("cid"), F.col(c).cast("double").alias("v"))
                      for i, c in enumerate(columns)])
    long = df.select(F.explode(cells).alias("cell")).select("cell.cid", "cell.v").where(F.col("v").isNotNull())
    return long.groupBy("cid", "v").agg(F.count(F.lit(1)).alias("n"))


def ranked_ranges(counts: DataFrame, ranks: DataFrame, range_values: int = 200_000) -> DataFrame:
    """cid, v, n, before: the value counts in the ranges that hold the wanted ``ranks`` (cid, k),
    with the rows of the column before the range."""
    ranged = in_ranges(counts, [F.col("cid"), F.col("v")], range_values)
    sums = totals_before(ranged, ["n"], ["cid"]).select("cid", RANGE, F.col("n").alias("rows"), F.col("before_n").alias("before"))
    holds = (F.col("k") >= F.col("before")) & (F.col("k") < F.col("before") + F.col("rows"))
    held = sums.join(F.broadcast(ranks), "cid").where(holds).select("cid", RANGE, "before").distinct()
    return ranged.join(F.broadcast(held), ["cid", RANGE])  # a range per wanted rank at most


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], range_values: int = 200_000) -> dict:
    """{column: [value at each prob]} with linear interpolation between order statistics
    (DuckDB ``quantile_cont``, Spark ``percentile``); None for an all-null column."""
    columns = list(columns)
    counts = materialize(_value_counts(df, columns), "value-counts")
    sizes = {r["cid"]: r["rows"] for r in counts.groupBy("cid").agg(F.sum("n").alias("rows")).collect()}
    spots = {(cid, p): p * (rows - 1) for cid, rows in sizes.items() for p in probs}
    wanted = sorted({(cid, k) for (cid, _), h in spots.items() for k in (math.floor(h), math.ceil(h))})
    found = {}
    if wanted:
        ranks = df.sparkSession.createDataFrame(wanted, "cid int, k long")
        upto = F.sum("n").over(Window.partitionBy("cid", RANGE).orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
        ends = ranked_ranges(counts, ranks, range_values).withColumn("end", F.col("before") + upto)
        hit = ends.join(F.broadcast(ranks), "cid").where((F.col("k") < F.col("end")) & (F.col("k") >= F.col("end") - F.col("n")))
        found = {(r["cid"], r["k"]): r["v"] for r in hit.select("cid", "k", "v").collect()}  # two values per column and prob at most
    out = {c: [None for _ in probs] for c in columns}
    for cid, c in enumerate(columns):
        for i, p in enumerate(probs):
            if cid in sizes:
                h = spots[cid, p]
                low, high = found[cid, math.floor(h)], found[cid, math.ceil(h)]
                out[c][i] = low + (h - math.floor(h)) * (high - low)
    return out
