"""Data-quality operators: null audit, any-null rows, numeric profile, price invariant."""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _unpivot_row(agg: DataFrame, names: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """One aggregate row with ``<name>__<stat>`` columns -> one row per name (bounded by the column count)."""
    cells = F.array(*[F.struct(F.lit(n).alias("column_name"),
                               *[F.col(f"{n}__{v}").alias(v) for v in value_cols]) for n in names])
    return agg.select(F.explode(cells).alias("c")).select("c.*")


def null_audit(df: DataFrame, columns: Optional[Sequence[str]] = None) -> DataFrame:
    """(column_name, n_null) for every column, from a single aggregate."""
    cols = list(columns or df.columns)
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__n_null") for c in cols])
    return _unpivot_row(agg, cols, ["n_null"])


def rows_with_any_null(df: DataFrame, columns: Optional[Sequence[str]] = None) -> DataFrame:
    cols = list(columns or df.columns)
    return df.where(reduce(or_, [F.col(c).isNull() for c in cols]))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def numeric_profile(df: DataFrame, columns: Optional[Sequence[str]] = None) -> DataFrame:
    """(column_name, n, mean, min, max) for the numeric columns, from a single aggregate."""
    cols = list(columns or numeric_columns(df))
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    return _unpivot_row(df.agg(*aggs), cols, ["n", "mean", "min", "max"])


def price_invariant(features: DataFrame, a: str = "total_item_price", b: str = "order_price",
                    tol: float = 1e-6) -> DataFrame:
    """Distinct values of the check ``|a - b| <= tol`` (null where either side is null)."""
    return features.select((F.abs(F.col(a) - F.col(b)) <= F.lit(tol)).alias("check")).distinct()
