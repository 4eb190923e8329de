"""Helpers shared by the text operators.

Text work inside tasks is done on whole Arrow columns: a batch is cut into slices of
bounded text size, each slice is split into words once, the words are dictionary-encoded,
and everything else is numpy on the integer codes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20
U64 = np.uint64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def id_crc32(doc_id: Column) -> Column:
    """crc32 of the id written as text (null id: of the empty text), the fold key of the labelled rows."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``limit`` bytes of text (one row at least)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
        pa.default_memory_pool().release_unused()


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column as plain strings, null as empty."""
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: (row offsets into the codes, codes, distinct words)."""
    parts = pc.ascii_split_whitespace(texts)
    flat = parts.flatten()
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(filled, dtype=np.int64)))
    lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    offsets = before[np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))]
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    return offsets, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def word_hashes(words: pa.Array) -> np.ndarray:
    """Stable 64-bit hash of each string."""
    from pandas.util import hash_array
    return hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False).astype(U64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x9E3779B97F4A7C15)
    x = x ^ (x >> U64(29))
    x = x * U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> U64(32))


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values[offsets[i]:offsets[i + 1]]`` for each row, empty rows 0."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[offsets[1:]] - total[offsets[:-1]]


def row_numbers(offsets: np.ndarray) -> np.ndarray:
    """For each value its row."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def append_columns(batch: pa.RecordBatch, **columns) -> pa.RecordBatch:
    arrays = [*batch.columns, *(x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values())]
    return pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *columns])


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[start:start + length]`` over all pairs."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return values[:0]
    shift = np.repeat(starts - (ends - lengths), lengths)
    return values[np.arange(ends[-1]) + shift]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and their offsets."""
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = b"".join(x.as_buffer() for x in texts)
    return np.frombuffer(joined, np.uint8), np.concatenate(([0], np.cumsum(size)))


def in_repeated_window(codes: np.ndarray, offsets: np.ndarray, n_distinct: int, width: int = 3) -> np.ndarray:
    """Per word: whether it lies in a window of ``width`` words found twice or more in its row."""
    marked = np.zeros(len(codes) + 1, np.int64)
    row = row_numbers(offsets)
    n = len(codes) - width + 1
    if n > 0:
        key = codes[:n]
        for k in range(1, width):
            if float(max(1, key.max())) * (n_distinct + 1) >= 2 ** 62:
                key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            key = key * (n_distinct + 1) + codes[k:n + k]
        inside = np.flatnonzero(row[:n] == row[width - 1:])
        order = inside[np.argsort(key[inside], kind="stable")]  # stable: a row's equal windows stand together
        same = (key[order[1:]] == key[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        at = order[twice]
        np.add.at(marked, at, 1)
        np.add.at(marked, at + width, -1)
    return np.cumsum(marked[:-1]) > 0


def count_bytes(raw: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Bytes of each text (offsets ``ends``) for which the 256-entry table ``wanted`` is true."""
    return np.diff(np.searchsorted(np.flatnonzero(wanted[raw]), ends))
