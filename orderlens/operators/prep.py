"""Deterministic split, mean imputation, winsorising and min-max scaling.

Imputer and winsoriser are ML estimators: their fitted models are stages that a
``PipelineModel`` saves, loads and applies with the others. Every fit is one aggregate over the training rows that returns one number per column
(bounded, so it is collected); every apply is a single ``select`` of literal-parameter
expressions over all rows at once. The split is a column, not three DataFrames, so
train / test / validation are prepared in one pass and filtered afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Optional, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.columns import clip, keyed_bucket

TRAIN, TEST, VALIDATION = "train", "test", "validation"


def keyed_split(df: DataFrame, key: str = "order_id", train_pct: int = 70, test_pct: int = 15,
                col: str = "split") -> DataFrame:
    """70 / 15 / 15 split from an md5 bucket of the key: stable under repartitioning and
    retries, and rows sharing a key (tied reviews) stay in one split."""
    b = keyed_bucket(F.col(key), 100)
    split = (F.when(b < train_pct, F.lit(TRAIN))
             .when(b < train_pct + test_pct, F.lit(TEST))
             .otherwise(F.lit(VALIDATION)))
    return df.withColumn(col, split)


def only(df: DataFrame, split: str, col: str = "split") -> DataFrame:
    return df.where(F.col(col) == split)


def dropna_subset(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(subset))


def _is_integral(dt: T.DataType) -> bool:
    return isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


class _FittedColumns(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A model that is a few numbers per column, kept as params and so saved with the stage."""

    def __init__(self):
        super().__init__()
        self.columns = Param(self, "columns", "the columns that the model changes")

    def names(self) -> list[str]:
        return self.getOrDefault(self.columns)


class MeanImputerModel(_FittedColumns):
    """Fills nulls with the means of the fit; a column without a mean (all null there) keeps its nulls."""

    def __init__(self, means: Optional[dict] = None, int_mode: str = "truncate"):
        super().__init__()
        self.values = Param(self, "values", "mean of each column, null where there was none")
        self.intMode = Param(self, "intMode", "truncate: an integral column keeps its type; double: it becomes double")
        means = means or {}
        self._set(columns=list(means), values=[None if m is None else float(m) for m in means.values()], intMode=int_mode)

    @property
    def means(self) -> dict:
        return dict(zip(self.names(), self.getOrDefault(self.values)))

    def parameters(self, spark) -> DataFrame:
        return spark.createDataFrame(list(self.means.items()), "column_name string, mean double")

    def _transform(self, df: DataFrame) -> DataFrame:
        means, truncate = self.means, self.getOrDefault(self.intMode) == "truncate"
        exprs = []
        for f in df.schema.fields:
            mean, col = means.get(f.name), F.col(f"`{f.name}`")
            if mean is None:
                exprs.append(col)
            elif _is_integral(f.dataType) and not truncate:
                exprs.append(F.coalesce(col.cast("double"), F.lit(mean)).alias(f.name))
            else:
                exprs.append(F.coalesce(col, F.lit(mean).cast(f.dataType)).alias(f.name))
        return df.select(*exprs)


class MeanImputer(Estimator):
    """Fill nulls with the training mean. Into an integral column the mean is truncated
    and the type kept (as ``na.fill`` does); ``int_mode="double"`` casts to double instead."""

    def __init__(self, columns: Sequence[str], int_mode: str = "truncate"):
        super().__init__()
        self.column_names, self.int_mode = list(columns), int_mode

    def _fit(self, train: DataFrame) -> MeanImputerModel:
        row = train.agg(*[F.avg(c).alias(c) for c in self.column_names]).first()
        return MeanImputerModel({c: row[c] for c in self.column_names}, self.int_mode)


class WinsorizerModel(_FittedColumns):
    """Clips columns to the bounds of the fit; nulls stay null, clipped columns become double."""

    def __init__(self, bounds: Optional[dict] = None):
        super().__init__()
        self.lower = Param(self, "lower", "lower bound of each column, null where there was no value")
        self.upper = Param(self, "upper", "upper bound of each column, null where there was no value")
        ends = [[None if x is None else float(x) for x in b] for b in (bounds or {}).values()]
        self._set(columns=list(bounds or {}), lower=[lo for lo, _ in ends], upper=[hi for _, hi in ends])

    @property
    def bounds(self) -> dict:
        return {c: (lo, hi) for c, lo, hi in zip(self.names(), self.getOrDefault(self.lower), self.getOrDefault(self.upper))}

    def parameters(self, spark) -> DataFrame:
        return spark.createDataFrame([(c, lo, hi) for c, (lo, hi) in self.bounds.items()], "column_name string, lo double, hi double")

    def _transform(self, df: DataFrame) -> DataFrame:
        bounds, exprs = self.bounds, []
        for c in df.columns:
            col = F.col(f"`{c}`")
            if c in bounds:
                lo, hi = bounds[c]
                exprs.append((col if lo is None else clip(col, lo, hi)).cast("double").alias(c))
            else:
                exprs.append(col)
        return df.select(*exprs)


class Winsorizer(Estimator):
    """Clip columns to [q(lower), q(upper)] fitted on training rows.

    ``method="exact"`` is linear-interpolated percentiles (``percentile_cont``), found by
    distributed selection (``orderlens.operators.quantiles``). ``method="sketch"`` merges KLL
    sketches of each ``group`` (``orderlens.operators.sketches``), which may be kept and merged
    for other spans: ``WinsorizerModel(merged bounds)``. ``method="approx"`` is Spark's GK sketch with relative error ``rel_err`` (0.01 is the studied workflow's setting, where
    the 1% and 99% points come back as min and max).
    """

    def __init__(self, columns: Sequence[str], lower: float = 0.01, upper: float = 0.99, method: str = "exact", rel_err: float = 0.01,
                 group: Sequence[str] = ("order_month",)):
        super().__init__()
        self.column_names, self.lower, self.upper, self.method, self.rel_err, self.group = list(columns), lower, upper, method, rel_err, list(group)

    def _fit(self, train: DataFrame) -> WinsorizerModel:
        probs = [self.lower, self.upper]
        if self.method == "approx":
            acc = max(1, int(round(1.0 / self.rel_err)))
            row = train.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, acc).alias(c) for c in self.column_names]).first()
            return WinsorizerModel({c: tuple(row[c]) if row[c] else (None, None) for c in self.column_names})
        if self.method == "sketch":
            from orderlens.operators.sketches import merged_quantiles, quantile_sketches
            q = merged_quantiles(quantile_sketches(train, self.column_names, self.group), self.column_names, probs)
            return WinsorizerModel({c: tuple(q[c]) for c in self.column_names})
        from orderlens.operators.quantiles import exact_quantiles
        q = exact_quantiles(train, self.column_names, probs)
        return WinsorizerModel({c: tuple(q[c]) for c in self.column_names})


@dataclass
class ScalarMinMax:
    """Min-max scale numeric columns to [0, 1] with training min / max; a constant column
    maps to 0.5, as MLlib's ``MinMaxScaler`` does per vector slot."""

    columns: Sequence[str]
    ranges: dict = field(default_factory=dict)

    def fit(self, train: DataFrame) -> "ScalarMinMax":
        aggs = []
        for c in self.columns:
            aggs += [F.min(F.col(c).cast("double")).alias(f"{c}__min"), F.max(F.col(c).cast("double")).alias(f"{c}__max")]
        row = train.agg(*aggs).first()
        self.ranges = {c: (row[f"{c}__min"], row[f"{c}__max"]) for c in self.columns}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = []
        for c in df.columns:
            if c in self.ranges:
                lo, hi = self.ranges[c]
                x = F.col(c).cast("double")
                if lo is None:
                    exprs.append(x.alias(c))
                elif hi == lo:
                    exprs.append(F.when(x.isNotNull(), F.lit(0.5)).alias(c))
                else:
                    exprs.append(((x - F.lit(lo)) / F.lit(hi - lo)).alias(c))
            else:
                exprs.append(F.col(c))
        return df.select(*exprs)


@dataclass
class Prepared:
    """Output of ``prepare``: all rows with a ``split`` column, plus the fitted steps."""

    data: DataFrame
    imputer: MeanImputerModel
    winsorizer: WinsorizerModel

    def split(self, name: str) -> DataFrame:
        return only(self.data, name)


def prepare(base: DataFrame, impute_columns: Sequence[str], winsor_columns: Sequence[str],
            winsor_method: str = "exact", rel_err: float = 0.01,
            dropna_columns: Optional[Sequence[str]] = ("payment_types",), persist: bool = True) -> Prepared:
    """dropna -> keyed split -> mean imputation and winsorising, both fitted on train.

    The split base table is written once to the checkpoint folder (``persist``): the
    fits and the output then read one row per labelled order instead of re-running the
    feature build over the fact tables for every job."""
    df = dropna_subset(base, dropna_columns) if dropna_columns else base
    df = keyed_split(df)
    if persist:
        from orderlens.sources.files import materialize
        df = materialize(df, "split-base")
    imputer = MeanImputer(impute_columns).fit(only(df, TRAIN))
    filled = imputer.transform(df)
    wins = Winsorizer(winsor_columns, method=winsor_method, rel_err=rel_err).fit(only(filled, TRAIN))
    return Prepared(wins.transform(filled), imputer, wins)
