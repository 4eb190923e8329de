"""Best-fit packing of token sequences: large items by matching, small ones into the gaps.

Lengths are whole numbers up to the capacity, so the plan needs only a histogram of them,
of at most ``capacity`` rows however many documents there are. On that histogram

1. items above a third of the capacity, of which at most two share a sequence, are matched
   greedily from the largest down, each with the largest partner that still fits;
2. smaller items, from the largest down, go where the smallest sufficient gap is left, and
   open new sequences only where none is.

The plan is a list of runs ("items rank0.. of this length go, so many each, to sequences
seq0.. at this offset"). Every piece is then ranked among the pieces of its length, in
groups of about the square root of their number, so that a very common length is spread over
many tasks, and looks up its run.

Defined cases: a null text is empty; an empty document is the end id alone; repeated rows
are packed as often as they occur; null ids are packed like others; an empty table gives
an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orderlens.llm.common import ragged, slices, texts_of

CAPACITY = 2048
END_ID = 0
#: Text that is encoded at once: the more, the fewer words are encoded again.
BLOCK_BYTES = 6 << 20
TOKENIZER = "byte_bpe_50k.json"
#: Words a worker remembers the ids of; the others are encoded again in each slice.
REMEMBERED = 200_000
#: A space after a space or control character, spaces beyond ASCII, and special tokens: such
#: texts are not cut at spaces before they are encoded.
_UNCUT = (r"[\x00-\x20\x7f]\x20|[\x{80}-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{2064}\x{3000}\x{feff}]|<\|")
_LOADED: dict[str, tuple] = {}


def _tokenizer(name: str) -> tuple:
    """(tokenizer, remembered words) of this worker."""
    if name not in _LOADED:
        import os

        import public_tokenizers
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _LOADED[name] = (tokenizer, {})
    return _LOADED[name]


def _ids(name: str, words: list[str], again: np.ndarray) -> list[bytes]:
    """Ids of each string as packed 32-bit numbers; those that came ``again`` are remembered."""
    tokenizer, memory = _tokenizer(name)
    found = [memory.get(w) for w in words]
    missing = [i for i, x in enumerate(found) if x is None]
    for start in range(0, len(missing), 20_000):
        at = missing[start:start + 20_000]
        for i, e in zip(at, tokenizer.encode_batch_fast([words[i] for i in at], add_special_tokens=False)):
            found[i] = array("I", e.ids).tobytes()
            if again[i] and len(memory) < REMEMBERED:
                memory[words[i]] = found[i]
    return found


def encode(texts: pa.Array, name: str = TOKENIZER) -> tuple[np.ndarray, np.ndarray]:
    """Ids of byte-level BPE for each text: (ids one text after the other, ids of each text).

    Texts are cut before each space that follows a visible character, a place where the
    tokenizer always cuts too; a slice's distinct pieces are encoded once.
    """
    whole = pc.match_substring_regex(texts, _UNCUT).to_numpy(zero_copy_only=False)
    parts = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
    n_parts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    first = np.zeros(len(coded), bool)
    first[np.cumsum(n_parts) - n_parts] = True
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + np.where(first, 0, len(coded.dictionary))
    used, code, often = np.unique(code, return_inverse=True, return_counts=True)
    words = coded.dictionary.to_pylist()
    strings = [words[u] if u < len(words) else " " + words[u - len(words)] for u in used.tolist()]
    blobs = _ids(name, strings, often > 1)
    size = np.fromiter((len(b) // 4 for b in blobs), np.int64, len(blobs))
    store = np.frombuffer(b"".join(blobs), np.uint32)
    lengths = size[code]
    ids = ragged(store, (np.cumsum(size) - size)[code], lengths)
    per_text = np.add.reduceat(lengths, np.cumsum(n_parts) - n_parts) if len(texts) else np.zeros(0, np.int64)
    if not whole.any():
        return ids, per_text
    pieces = np.split(ids, np.cumsum(per_text)[:-1])
    tokenizer = _tokenizer(name)[0]
    for i in np.flatnonzero(whole):
        pieces[i] = np.array(tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, np.uint32)
    return np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)


def pieces(docs: DataFrame, capacity: int = CAPACITY, name: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document's pieces.

    A document is its ids and the end id. One above the capacity is cut so that all its
    pieces but the first are full.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
                          + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=BLOCK_BYTES):
                ids, n = encode(texts_of(part), name)
                ends = np.cumsum(n)
                ids = np.insert(ids, ends, END_ID).astype("<u4")
                n = n + 1
                start = np.cumsum(n) - n
                count = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                stop = n[row] - (count[row] - 1 - piece) * capacity  # full pieces end the document
                begin = np.maximum(stop - capacity, 0)
                at, length = start[row] + begin, stop - begin
                crc = [zlib.crc32(ids[a:a + k]) for a, k in zip(at.tolist(), length.tolist())]
                columns = [part.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(begin), pa.array(length),
                           pa.array(crc, pa.int64())]
                if with_ids:  # pieces lie one after the other, as the ids do
                    ends32 = np.concatenate((at, [len(ids)])).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends32), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, rank0, per_sequence, seq0, offset) that place every item of a histogram.

    Items rank0 and on of that length go per_sequence each to the sequences from seq0 on,
    side by side from offset on, up to the next run of the length.
    """
    left = dict(counts)
    done: list[tuple[int, tuple]] = []                 # (sequences, contents) of classes without a usable gap
    gaps: dict[int, list[tuple[int, tuple]]] = {}      # gap -> classes of sequences that leave it
    order: list[int] = []                              # the gaps, ascending

    def keep(gap: int, n: int, contents: tuple) -> None:
        if not n:
            return
        if not gap:
            done.append((n, contents))
        elif gap in gaps:
            gaps[gap].append((n, contents))
        else:
            gaps[gap] = [(n, contents)]
            insort(order, gap)

    large = sorted(s for s in left if 3 * s > capacity)
    for size in reversed(large):
        while left[size]:
            at = bisect_left(large, min(size, capacity - size) + 1) - 1
            while at >= 0 and left[large[at]] < (2 if large[at] == size else 1):
                at -= 1
            if at < 0:
                keep(capacity - size, left[size], ((size, 1),))
                left[size] = 0
            elif large[at] == size:
                n = left[size] // 2
                keep(capacity - 2 * size, n, ((size, 2),))
                left[size] -= 2 * n
            else:
                n = min(left[size], left[large[at]])
                keep(capacity - size - large[at], n, ((size, 1), (large[at], 1)))
                left[size] -= n
                left[large[at]] -= n
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            at = bisect_left(order, size)
            if at == len(order):
                each = capacity // size
                gap, n, contents = capacity, max(1, left[size] // each), ()
            else:
                gap = order[at]
                n, contents = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[at]
                each = gap // size
            full = min(n, left[size] // each)
            if full:
                keep(gap - each * size, full, (*contents, (size, each)))
                if gap < capacity or contents:
                    keep(gap, n - full, contents)
                left[size] -= full * each
            else:
                keep(gap - left[size] * size, 1, (*contents, (size, left[size])))
                if gap < capacity or contents:
                    keep(gap, n - 1, contents)
                left[size] = 0
    runs, rank, seq = [], dict.fromkeys(counts, 0), 0
    for n, contents in [*done, *(x for g in order for x in gaps[g])]:
        offset = 0
        for size, each in contents:
            runs.append((size, rank[size], each, seq, offset))
            rank[size] += n * each
            offset += size * each
        seq += n
    return runs


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (doc_id, piece, length, ids_crc32 and more) with sequence_id and offset.

    ``items`` is read twice, so pass a written table.
    """
    histogram = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    runs = np.array(sorted(plan(histogram, capacity)), np.int64).reshape(-1, 5)
    spark = items.sparkSession
    groups = spark.createDataFrame([(k, int(np.ceil(np.sqrt(n)))) for k, n in histogram.items()], "length long, __groups int")
    identity = ["doc_id", "piece", "ids_crc32"]
    grouped = (items.join(F.broadcast(groups), "length")
               .withColumn("__group", F.pmod(F.xxhash64(*identity), F.col("__groups")).cast("int")).drop("__groups"))
    sizes = grouped.groupBy("length", "__group").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("length", "__group", F.coalesce(before, F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("length", "__group").orderBy(*identity))
    ranked = (grouped.withColumn("__rank", within - 1).join(starts, ["length", "__group"])
              .withColumn("__rank", F.col("__rank") + F.col("__before")).drop("__group", "__before"))
    shared = spark.sparkContext.broadcast(runs)
    out = T.StructType([f for f in ranked.schema if f.name != "__rank"] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        keys = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("__rank").to_numpy(zero_copy_only=False).astype(np.int64)
            hit = table[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
            past = rank - hit[:, 1]
            rest = [batch.column(f.name) for f in out.fields[:-2]]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(hit[:, 3] + past // hit[:, 2]), pa.array(hit[:, 4] + past % hit[:, 2] * length)],
                                             names=out.names)
    return ranked.mapInArrow(run, out)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, name: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """Encode, cut and pack all documents."""
    from orderlens.sources.files import materialize
    return pack(materialize(pieces(docs, capacity, name, with_ids), "pieces"), capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlens.llm.common import documents
    return pack_documents(documents(spark, sf_dir)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
