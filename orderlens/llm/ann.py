"""Nearest neighbours by a block matrix join on int8 vectors with error bounds.

Vectors are scaled to length one and rounded to int8, and the length of each rounding error
is kept. Query blocks meet candidate blocks in tiles; a tile's matrix product of int8
vectors (whole numbers, exact in float32 up to 1,040 dimensions, in float64 beyond) gives
every cosine up to a bound: ``|e_a| + |a_q| * |e_b|``. Pairs that cannot reach a query's
k-th best lower bound are dropped; the others are computed anew in double precision on
the original vectors, and each tile hands on the k best of a query. The result is exact.

Candidates are copied once per query block and queries once per candidate block, so a
tile is of bounded size however many vectors there are.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
and rows with a null id take no part; only vectors of equal dimension meet; rows that
repeat an id are one candidate, as near as its nearest vector, and as a query find what
either vector finds; ties go to the smaller id; a query without candidates has no rows;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.sources.files import materialize

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 4096
CHUNK = 128
FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of the rows that take part."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select("vec_id", v.cast("array<double>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).distinct())


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, raw (doubles), whole (int8), scale, error of each usable vector."""
    schema = "vec_id long, dim int, raw binary, whole binary, scale double, error double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            dims = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                at = pa.array(np.flatnonzero(dims == dim))
                raw = column.take(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                peak = np.abs(raw).max(axis=1, keepdims=True)
                unit = raw / peak  # first by the peak, so that tiny and huge vectors keep a length
                unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
                scale = np.abs(unit).max(axis=1) / 127
                whole = np.rint(unit / scale[:, None]).astype(np.int8)
                rest = unit - whole * scale[:, None]
                error = np.sqrt((rest * rest).sum(axis=1)) + 1e-12  # rounding of the bound itself
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").take(at), pa.array(np.full(len(raw), dim, np.int32)),
                    pa.array([r.tobytes() for r in np.ascontiguousarray(raw)], pa.binary()),
                    pa.array([r.tobytes() for r in whole], pa.binary()), pa.array(scale), pa.array(error)],
                    names=["vec_id", "dim", "raw", "whole", "scale", "error"])
    return vectors.mapInArrow(run, schema)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the rows of two matrices, in double precision and always summed alike.

    Rows are first scaled by a power of two, which changes no digit but keeps squares finite.
    """
    def scaled(x):
        return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])

    def root(x):
        return np.sqrt((x * x).sum(axis=1))
    a, b = scaled(a), scaled(b)
    return (a * b).sum(axis=1) / (root(a) * root(b))


def _matrix(column: pd.Series, kind, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(-1, dim)


def tile_best(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of each query of a tile."""
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
    if not len(queries) or not len(candidates):
        return empty
    dim = int(queries["dim"].iloc[0])
    exact = np.float32 if dim <= 1040 else np.float64
    candidates = candidates.sort_values("vec_id", kind="stable")
    ids = candidates["vec_id"].to_numpy()
    starts = np.concatenate(([0], np.flatnonzero(np.diff(ids)) + 1))
    whole, raw = _matrix(candidates["whole"], np.int8, dim).astype(exact), _matrix(candidates["raw"], np.float64, dim)
    scale, error = candidates["scale"].to_numpy(), candidates["error"].to_numpy()
    out = []
    for at in range(0, len(queries), CHUNK):
        part = queries.iloc[at:at + CHUNK]
        own, q_scale, q_error = part["vec_id"].to_numpy(), part["scale"].to_numpy()[:, None], part["error"].to_numpy()[:, None]
        q_raw = _matrix(part["raw"], np.float64, dim)
        near = (_matrix(part["whole"], np.int8, dim).astype(exact) @ whole.T).astype(np.float64) * q_scale * scale
        slack = q_error + (1 + q_error) * error + 1e-9
        near[own[:, None] == ids] = -np.inf
        by_id = np.maximum.reduceat(near - slack, starts, axis=1) if len(starts) < len(ids) else near - slack
        kept = min(k, by_id.shape[1])
        least = np.partition(by_id, by_id.shape[1] - kept, axis=1)[:, by_id.shape[1] - kept]
        q, c = np.nonzero((near + slack >= least[:, None]) & (near > -np.inf))
        out.append(pd.DataFrame({"query_id": own[q], "vec_id": ids[c], "score": cosine(q_raw[q], raw[c])}))
    found = pd.concat(out).groupby(["query_id", "vec_id"], as_index=False)["score"].max() if out else empty
    return found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id", sort=False).head(k)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other vectors of every query row."""
    rows = materialize(quantised(usable(vectors)), "vectors")
    queries = rows.where(is_query)
    n_c = max(1, -(-rows.count() // CANDIDATE_BLOCK))
    n_q = max(1, -(-queries.count() // QUERY_BLOCK))
    spread = F.xxhash64(F.lit("block"), "vec_id")
    q = queries.withColumn("q_block", F.pmod(spread, F.lit(n_q)).cast("int")).withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))
    c = rows.withColumn("c_block", F.pmod(spread, F.lit(n_c)).cast("int")).withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    tile = ["dim", "q_block", "c_block"]
    found = q.groupBy(*tile).cogroup(c.groupBy(*tile)).applyInPandas(lambda a, b: tile_best(a, b, k), FOUND)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_int8_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, 5)
