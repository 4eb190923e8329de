"""Readers and writers: CSV and Parquet tables, temp views, MLlib models."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, fields
from typing import Optional

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.sources.schemas import SCHEMAS


@dataclass
class Tables:
    """The five logical tables. ``reviews`` is absent for a scoring set."""

    orders: DataFrame
    items: DataFrame
    payments: DataFrame
    products: DataFrame
    reviews: Optional[DataFrame] = None


TABLE_FILES = {
    "orders": "orders",
    "items": "order_items",
    "payments": "order_payments",
    "products": "products",
    "reviews": "order_reviews",
}


CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, keep_corrupt: bool = False) -> DataFrame:
    """CSV with a declared schema: one scan, no inference pass, stable types.

    Timestamps are read as text and parsed by ``try_to_timestamp`` (a malformed one is null).
    A line that does not fit the schema gives nulls (PERMISSIVE); ``keep_corrupt`` keeps its
    text in the column ``_corrupt_record``, so that such lines can be counted.
    """
    stamps = [f.name for f in schema if isinstance(f.dataType, T.TimestampType)]
    raw = T.StructType([T.StructField(f.name, T.StringType() if f.name in stamps else f.dataType) for f in schema]
                       + [T.StructField(CORRUPT, T.StringType())] * keep_corrupt)
    rows = (spark.read.schema(raw)
            .option("header", header)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path))
    return rows.withColumns({c: F.try_to_timestamp(F.col(c)) for c in stamps}) if stamps else rows


def corrupt_counter(rows: DataFrame, name: str = "corrupt") -> tuple[DataFrame, Observation]:
    """``rows`` of a ``read_csv(keep_corrupt=True)`` without that column, and an observation whose
    ``corrupt`` and ``rows`` are there once an action has read them all."""
    seen = Observation(name)
    # All columns are counted, as the CSV reader only checks the ones that a query needs.
    every = [F.count(F.col(c)).alias(f"known_{c}") for c in rows.columns if c != CORRUPT]
    counted = rows.observe(seen, F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt"), F.count(F.lit(1)).alias("rows"), *every)
    return counted.drop(CORRUPT), seen


def corrupt_records(rows: DataFrame) -> int:
    """How many lines of a ``read_csv(keep_corrupt=True)`` did not fit the schema."""
    return rows.agg(F.count_if(F.col(CORRUPT).isNotNull()), *[F.count(c) for c in rows.columns]).first()[0]


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Directory of part files with a header line each, as Spark writes CSV."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


_SCOPES = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Folders that ``materialize`` writes in this block (and thread) are deleted when it ends, but
    those it is told to keep. For a caller that has written its result by then."""
    if not hasattr(_SCOPES, "open"):
        _SCOPES.open = []
    _SCOPES.open.append([])
    try:
        yield
    finally:
        for path in _SCOPES.open.pop():
            fs, where = _file_system(spark, path)
            fs.delete(where, True)


#: Whether a query's shuffle files go when it ends (else when the driver's collector finds them unused).
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that are built and run in this block go when each ends. For
    steps that write what later ones read; the session's setting is put back after them."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)


def materialize(df: DataFrame, name: str, kept: bool = False, outer: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into a fresh folder under the cluster's checkpoint folder and
    read it back: cuts the lineage (a lost executor re-reads files instead of replaying
    the plan) and lets later jobs prune columns. In a ``scratch_scope`` the folder goes with
    it, unless ``kept``; with ``outer`` it goes with the scope around that one, if there is one."""
    from orderlens.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    scopes = getattr(_SCOPES, "open", None) or []
    if len(scopes) > outer and not kept:
        scopes[-2 if outer else -1].append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_tables(spark: SparkSession, folder: str, fmt: str = "csv", with_reviews: bool = True,
                counters: Optional[dict[str, Observation]] = None) -> Tables:
    """Load ``orders.csv``, ``order_items.csv`` ... (or ``.parquet``) from one folder.

    With a dict as ``counters``, an observation per CSV table is put there under the table's
    name: the first job that reads a table also counts its lines and those that do not fit."""
    out = {}
    for attr, name in TABLE_FILES.items():
        if attr == "reviews" and not with_reviews:
            continue
        path = f"{folder.rstrip('/')}/{name}.{fmt}"
        if fmt != "csv":
            out[attr] = read_parquet(spark, path)
        elif counters is None:
            out[attr] = read_csv(spark, path, SCHEMAS[name])
        else:
            out[attr], counters[name] = corrupt_counter(read_csv(spark, path, SCHEMAS[name], keep_corrupt=True), name)
    return Tables(**out)


def register_views(tables: Tables, prefix: str = "") -> list[str]:
    """Register every present table as a temp view; returns the view names."""
    names = []
    for f in fields(tables):
        df = getattr(tables, f.name)
        if df is None:
            continue
        name = prefix + TABLE_FILES[f.name]
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def save_model(model, path: str, overwrite: bool = False) -> str:
    """Persist an ML model or pipeline; fails when ``path`` exists unless ``overwrite``.

    An overwriting save writes beside ``path`` first and then takes its place by renaming: a
    save that fails leaves the old model whole, and no reader sees half of each."""
    if not overwrite:
        model.write().save(path)
        return path
    fresh = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    spark = SparkSession.getActiveSession()
    try:
        model.write().save(fresh)
        _take_place(spark, fresh, path)
    finally:
        _file_system(spark, fresh)[0].delete(_file_system(spark, fresh)[1], True)
    return path


def _file_system(spark: SparkSession, path: str):
    """(the file system that holds ``path``, its path object)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _take_place(spark: SparkSession, fresh: str, path: str) -> None:
    fs, target = _file_system(spark, path)
    old = _file_system(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")[1]
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"{path} cannot be replaced")
    if not fs.rename(_file_system(spark, fresh)[1], target):
        if had:
            fs.rename(old, target)
        raise OSError(f"{path} cannot be written")
    if had:
        fs.delete(old, True)


def load_model(model_class, path: str):
    """Reload by concrete class, e.g. ``GBTClassificationModel`` or ``PipelineModel``."""
    return model_class.load(path)
