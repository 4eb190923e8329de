"""Word-level BPE through a distinct-word table.

The tokenizer drops white space and never merges across it, so a text's ids are those of
its words one after the other. Documents are read in blocks of bounded text size:

1. Every block is split into words and its distinct words are numbered, the most frequent
   first. They are dealt by hash to word buckets, a row for each block and bucket.
2. A bucket gathers its words from all blocks: the distinct-word table. Each distinct word
   is encoded once; the ids go back to the blocks by word number.
3. A block joins ids to its positions, and pieces to ids through the id-to-piece table
   (bounded by the tokenizer's vocabulary).

A very frequent word costs one entry per block, not one per occurrence, so no bucket grows
with a word's frequency. Texts are never shuffled, only word numbers. Both passes over the
documents must cut the same blocks; a block's key is a hash of its content, and a block
whose words did not come back stops the job.

Defined cases: null text is empty and has no ids; null ids are kept; repeated rows are
encoded like others; words without any id (Unicode white space) leave no trace; special
token strings are the special ids, as in the tokenizers library; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import ragged, slices, split_words, texts_of, word_hashes

TOKENIZER = "word_bpe_49k.json"
BLOCK_BYTES = 16 << 20
_LOADED: dict[str, tuple] = {}


def _tokenizer(name: str):
    """(tokenizer, pieces by id) of this worker."""
    if name not in _LOADED:
        import os

        import public_tokenizers
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        pieces = [""] * (max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1)
        for piece, i in tokenizer.get_vocab(with_added_tokens=True).items():
            pieces[i] = piece
        _LOADED[name] = (tokenizer, pieces)
    return _LOADED[name]


def _packed(values: np.ndarray) -> bytes:
    """32-bit numbers by byte planes, compressed."""
    return zstandard.compress(np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpacked(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _block(part: pa.RecordBatch) -> tuple[int, np.ndarray, np.ndarray, pa.Array]:
    """(key, row offsets, word numbers, words by number) of a slice of documents."""
    offsets, codes, words = split_words(texts_of(part))
    order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
    number = np.empty(len(words), np.int64)
    number[order] = np.arange(len(words))
    codes, words = number[codes] if len(codes) else codes, words.take(pa.array(order))
    key = xxhash.xxh64(codes.astype(np.int32).tobytes())
    key.update(offsets.tobytes())
    key.update(repr(part.column("doc_id").to_pylist()).encode())
    key.update("\n".join(words.to_pylist()).encode())
    return key.intdigest() - (1 << 63), offsets, codes, words


def _block_words(docs: DataFrame, n_buckets: int) -> DataFrame:
    """bucket, block, numbers, words: the distinct words of each block, dealt by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=BLOCK_BYTES):
                key, _, _, words = _block(part)
                if not len(words):
                    continue
                bucket = (word_hashes(words) % np.uint64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                text = words.to_pylist()
                starts = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]))
                rows = [order[a:b] for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(bucket[r[0]]) for r in rows], pa.int32()), pa.array([key] * len(rows), pa.int64()),
                    pa.array([_packed(np.diff(r, prepend=0)) for r in rows], pa.binary()),
                    pa.array([zstandard.compress("\n".join([text[i] for i in r.tolist()]).encode(), 3) for r in rows], pa.binary())],
                    names=["bucket", "block", "numbers", "words"])
    return docs.mapInArrow(run, "bucket int, block long, numbers binary, words binary")


def _encoded_words(words: DataFrame, name: str) -> DataFrame:
    """block, numbers, counts, ids: every distinct word of a bucket encoded once."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        tokenizer = _tokenizer(name)[0]
        lists = [zstandard.decompress(w).decode().split("\n") for w in rows["words"]]
        coded = pa.chunked_array([pa.array(x) for x in lists]).combine_chunks().dictionary_encode()
        table = coded.dictionary.to_pylist()
        blobs = []
        for start in range(0, len(table), 20_000):
            blobs += [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(table[start:start + 20_000], add_special_tokens=False)]
        size = np.fromiter((len(b) // 4 for b in blobs), np.int64, len(blobs))
        store, first = np.frombuffer(b"".join(blobs), np.uint32), np.cumsum(size) - size
        codes = np.split(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum([len(x) for x in lists])[:-1])
        return pd.DataFrame({"bucket": rows["bucket"], "block": rows["block"], "numbers": rows["numbers"], "counts": [_packed(size[c]) for c in codes],
                             "ids": [_packed(ragged(store, first[c], size[c])) for c in codes]})
    return words.groupBy("bucket").applyInPandas(run, "bucket int, block long, numbers binary, counts binary, ids binary")


def _block_positions(docs: DataFrame) -> DataFrame:
    """block, doc_ids, ends, positions: the word numbers of every text of a block."""
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)),
                           T.StructField("ends", T.BinaryType()), T.StructField("positions", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=BLOCK_BYTES):
                key, offsets, codes, _ = _block(part)
                yield pa.RecordBatch.from_arrays([
                    pa.array([key], pa.int64()), pa.array([part.column("doc_id").to_pylist()], pa.list_(part.column("doc_id").type)),
                    pa.array([_packed(np.diff(offsets))], pa.binary()), pa.array([_packed(codes)], pa.binary())], names=schema.names)
    return docs.mapInArrow(run, schema)


def _joined(positions: pd.DataFrame, words: pd.DataFrame) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block: doc ids, row offsets, word numbers, and each number's (first, count) in the ids."""
    if not len(positions):
        raise ValueError("words came back to a block that the second pass did not cut: the input is not read alike twice")
    words = words.drop_duplicates("bucket")  # blocks of equal content share a key
    numbers = [np.cumsum(_unpacked(x)) for x in words["numbers"]]
    number = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
    counts = np.concatenate([_unpacked(x) for x in words["counts"]]) if numbers else number
    ids = np.concatenate([_unpacked(x) for x in words["ids"]]) if numbers else number
    count, first = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
    count[number], first[number] = counts, np.cumsum(counts) - counts
    for row in positions.itertuples(index=False):
        codes = _unpacked(row.positions)
        if len(codes) and codes.max() >= len(number):
            raise ValueError("a block's words did not come back whole: the input is not read alike twice")
        yield list(row.doc_ids), np.concatenate(([0], np.cumsum(_unpacked(row.ends)))), codes, first, count, ids


def _assemble(docs: DataFrame, name: str, n_buckets: int | None, rows, schema) -> DataFrame:
    docs = docs.select("doc_id", "text")
    if n_buckets is None:  # as the cluster deals its shuffles
        n_buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = _encoded_words(_block_words(docs, n_buckets), name)
    return _block_positions(docs).groupBy("block").cogroup(words.groupBy("block")).applyInPandas(rows, schema)


def encode(docs: DataFrame, name: str = TOKENIZER, n_buckets: int | None = None) -> DataFrame:
    """doc_id, ids of every document."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def rows(positions: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc_ids, offsets, codes, first, count, ids in _joined(positions, words):
            for i, doc in enumerate(doc_ids):
                at = codes[offsets[i]:offsets[i + 1]]
                out.append((doc, ragged(ids, first[at], count[at]).astype(np.int32)))
        return pd.DataFrame({"doc_id": pd.Series([x[0] for x in out], dtype="Int64"), "ids": [x[1] for x in out]})
    return _assemble(docs, name, n_buckets, rows, schema)


def piece_table(spark: SparkSession, name: str = TOKENIZER) -> DataFrame:
    """id, piece: one row per entry of the tokenizer's vocabulary."""
    return spark.createDataFrame(list(enumerate(_tokenizer(name)[1])), "id int, piece string")


def decode(encoded: DataFrame, name: str = TOKENIZER) -> DataFrame:
    """doc_id, text of rows (doc_id, ids): ids joined to their pieces, put together by position."""
    keyed = encoded.withColumn("__row", F.monotonically_increasing_id())
    tokens = keyed.select("__row", "doc_id", F.posexplode_outer("ids").alias("position", "id"))
    named = tokens.join(F.broadcast(piece_table(encoded.sparkSession, name)), "id", "left")  # bounded by the vocabulary
    parts = F.array_sort(F.collect_list(F.struct("position", "piece")))
    return named.groupBy("__row", "doc_id").agg(F.array_join(F.transform(parts, lambda x: x["piece"]), " ").alias("text")).drop("__row")


def encode_and_decode(docs: DataFrame, name: str = TOKENIZER, n_buckets: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document.

    Pieces are looked up by id once for each distinct word of a block; texts and id lists
    exist only while their digest is taken.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def rows(positions: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        pieces = _tokenizer(name)[1]
        out = []
        for doc_ids, offsets, codes, first, count, ids in _joined(positions, words):
            listed = ids.tolist()
            spans = [listed[a:a + n] for a, n in zip(first.tolist(), count.tolist())]
            as_ids = [" ".join(map(str, x)) for x in spans]
            as_text = [" ".join([pieces[i] for i in x]) for x in spans]
            silent = bool(len(count)) and not count.all()
            for i, doc in enumerate(doc_ids):
                at = codes[offsets[i]:offsets[i + 1]]
                if silent:
                    at = at[count[at] > 0]
                word = at.tolist()
                out.append((doc, int(count[at].sum()), hashlib.sha256(" ".join([as_ids[k] for k in word]).encode()).hexdigest(),
                            hashlib.sha256(" ".join([as_text[k] for k in word]).encode()).hexdigest()))
        frame = pd.DataFrame(out, columns=schema.names)
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame
    return _assemble(docs, name, n_buckets, rows, schema)


def op3_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlens.llm.common import documents
    return encode_and_decode(documents(spark, sf_dir))
