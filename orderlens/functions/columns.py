"""Column expressions shared by the operators. All are built-in Spark functions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MICROS = 1_000_000


def _epoch_micros(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), c)
    return F.unix_micros(c)


def epoch_seconds_floor_micros(c: Column, dtype: T.DataType) -> Column:
    """Epoch time floored to whole seconds, in microseconds.

    Same as ``cast(ts as long) * 1e6`` on a session-zone timestamp, but also valid on
    TIMESTAMP_NTZ (which cannot be cast to a number) and independent of the session zone.
    """
    m = _epoch_micros(c, dtype)
    return m - F.pmod(m, F.lit(_MICROS))


def _seconds_between(start: Column, end: Column, dtype: T.DataType) -> Column:
    # Each side is floored first, then differenced, as casting both to epoch seconds does.
    diff = epoch_seconds_floor_micros(end, dtype) - epoch_seconds_floor_micros(start, dtype)
    return diff / F.lit(float(_MICROS))


def minutes_between(start: Column, end: Column, dtype: T.DataType) -> Column:
    return _seconds_between(start, end, dtype) / F.lit(60.0)


def days_between(start: Column, end: Column, dtype: T.DataType) -> Column:
    return _seconds_between(start, end, dtype) / F.lit(86400.0)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, null when den is 0 or null (ANSI mode would raise on 0)."""
    return F.try_divide(num, den)


def keyed_bucket(key: Column, buckets: int = 100) -> Column:
    """Deterministic bucket in [0, buckets) from the first 32 bits of md5(key).

    A pure function of the key: unlike ``randomSplit`` it does not change with the
    partitioning or task retries, and DuckDB can compute the same value.
    """
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return h % F.lit(buckets)


def clip(c: Column, lo, hi) -> Column:
    """Two-sided clip that keeps nulls null (``greatest``/``least`` would not)."""
    return F.when(c < F.lit(lo), F.lit(lo)).when(c > F.lit(hi), F.lit(hi)).otherwise(c)
