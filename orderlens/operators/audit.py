"""Counts as by-products of the job that writes the split base table.

``DataFrame.observe`` puts counters on the rows where they pass: nulls and the price check on
the features, split sizes on the rows written. No pass over the data is added. Counters of a
stage before a shuffle are added again when a lost executor makes its tasks run again, so
the features' row count is observed too and compared with the rows of the purchase window;
where they differ the audit is taken by a plain aggregate instead.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Optional, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderlens.operators.features import basetable, in_window, order_features
from orderlens.operators.prep import TEST, TRAIN, VALIDATION, dropna_subset, keyed_split
from orderlens.sources.files import Tables, materialize

SPLITS = (TRAIN, TEST, VALIDATION)


@dataclass
class Audit:
    """``nulls`` per feature column, rows with each outcome of the price ``check``, rows per split."""

    rows: int
    nulls: dict
    check: dict
    splits: dict

    def null_frame(self, spark) -> DataFrame:
        return spark.createDataFrame(list(self.nulls.items()), "column_name string, n_null long")

    def check_frame(self, spark) -> DataFrame:
        """The distinct outcomes of the check."""
        return spark.createDataFrame([(k,) for k, n in self.check.items() if n], "check boolean")

    def split_frame(self, spark) -> DataFrame:
        return spark.createDataFrame([(k, n) for k, n in self.splits.items() if n], "split string, n long")


def _counters(columns: Sequence[str], tol: float) -> list[Column]:
    equal = F.abs(F.col("total_item_price") - F.col("order_price")) <= F.lit(tol)
    return [F.count(F.lit(1)).alias("rows"), F.count_if(equal).alias("check_true"), F.count_if(~equal).alias("check_false"),
            F.count_if(equal.isNull()).alias("check_null"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]]


def _observed(counters: Observation) -> dict:
    """The counters, or nothing where the job found its input empty and left them out of its plan."""
    try:
        return counters.get
    except Py4JJavaError:
        return {}


def audited_split_base(tables: Tables, reviews: DataFrame, start: Optional[str] = None, end: Optional[str] = None,
                       columns: Optional[Sequence[str]] = None, dropna_columns: Sequence[str] = ("payment_types",),
                       tol: float = 1e-6) -> tuple[DataFrame, Audit]:
    """(the written base table of labelled orders with their split, its audit)."""
    features = order_features(tables, start, end)
    columns = list(columns or features.columns)
    seen, kept = Observation("features"), Observation("splits")
    base = basetable(features.observe(seen, *_counters(columns, tol)), reviews, keep_score=True)
    rows = keyed_split(dropna_subset(base, dropna_columns))
    rows = rows.observe(kept, *[F.count_if(F.col("split") == s).alias(s) for s in SPLITS])
    written = materialize(rows, "split-base")
    counts, splits = _observed(seen), _observed(kept)
    if counts.get("rows") != in_window(tables.orders, start, end).count():
        counts = features.agg(*_counters(columns, tol)).first().asDict()
    if sum(splits.get(s, 0) for s in SPLITS) != written.count():  # the second is read from the files' footers
        splits = {r["split"]: r["count"] for r in written.groupBy("split").count().collect()}
    return written, Audit(counts["rows"], {c: counts[f"null_{c}"] for c in columns},
                          {True: counts["check_true"], False: counts["check_false"], None: counts["check_null"]},
                          {s: splits.get(s, 0) for s in SPLITS})
