"""Ranks and running totals in a total order, without a global window.

Rows are dealt to ranges by ``repartitionByRange`` and written with the number of their
range, so a row finds its range in the shuffle's own binary search, however many ranges
there are. Totals of the ranges, one row each, are prefixed; each range then runs its own
window. Equal keys always lie in one range.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources.files import materialize

RANGE = "range_no"
#: More rows than this many ranges hold make the ranges longer; their windows spill.
MAX_RANGES = 10_000


def in_ranges(rows: DataFrame, order: Sequence[Column], range_rows: int) -> DataFrame:
    """``rows`` with the number of their range, ascending with the order. ``rows`` is read
    several times, so pass a written table."""
    n = min(MAX_RANGES, max(1, -(-rows.count() // range_rows)))
    if n == 1:
        return rows.withColumn(RANGE, F.lit(0))
    return materialize(rows.repartitionByRange(n, *order).withColumn(RANGE, F.spark_partition_id()), "ranges")


def totals_before(ranged: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """One row per group and range: the columns' sums there, and (``before_<column>``) over the ranges before it."""
    totals = ranged.groupBy(*group, RANGE).agg(*[F.sum(c).alias(c) for c in columns])
    # a row per range of a group
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns({f"before_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in columns})


def running_totals(ranged: DataFrame, columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``ranged`` with ``cum_<column>``: the column's sum over all rows up to this one."""
    offsets = totals_before(ranged, columns).drop(*columns)
    upto = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (ranged.join(offsets, RANGE)
            .withColumns({f"cum_{c}": F.sum(c).over(upto) + F.col(f"before_{c}") for c in columns})
            .drop(RANGE, *[f"before_{c}" for c in columns]))
