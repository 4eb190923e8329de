"""Phrase collocations: frequent word n-grams found by Misra-Gries summaries, counted exactly.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, pieces into words
at spaces and tabs. Everything is per language.

1. Documents are cut once into blocks of bounded text size and language, written with their
   distinct words and word numbers (0 where a piece ends). Word counts come from the blocks.
2. Level by level, for phrases of 2, 3, ... words: a block gives its phrases whose two
   one-word-shorter parts may both be frequent, as hashes with counts, one summary for each
   hash partition. A partition's summaries are merged as Misra-Gries summaries: whenever more
   than K hashes are held, the (K+1)-th largest count is taken off all. K exceeds the
   partition's mass divided by ``min_count``, so less than ``min_count`` is taken off in all
   and every phrase that frequent survives.
3. The survivors of a level become a bitmap of bounded size, in which the blocks look up the
   parts of the next level's phrases. A bit too many costs time, never a result: a full
   bitmap would let all phrases through.
4. A second pass counts the survivors by their words, exactly; sums of at least ``min_count``
   are the candidates. Scores are integer arithmetic in 38 digits.

A frequent phrase is one entry of each block's summary, so no task gets its occurrences; a
partition's mass is about ``PARTITION_MASS`` and a phrase's share of that.

Defined cases: null text is empty and has no words; null lang is ``und``; rows are counted as
often as they occur, ids are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.llm.common import mix64, slices, text_bytes, texts_of, word_hashes
from orderlens.sources.files import materialize

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
UNKNOWN_LANG = "und"
#: Text that makes one block at most.
BLOCK_BYTES = 8 << 20
#: Phrase occurrences for each hash partition of a level, about.
PARTITION_MASS = 4_000_000
#: Bits of a level's bitmap: 16 for each survivor up to this many (16 MB).
MAX_BITS = 1 << 27
#: Entries of summaries that are gathered before they are merged.
MERGE_AT = 400_000
#: Phrase occurrences, and distinct phrases, that a task gathers from its blocks before it sends them.
HELD_HASHES, HELD_PHRASES = 4_000_000, 400_000
#: Parts that the ranking of one language is spread over.
RANK_PARTS = 64

_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_GAP = _STOP.copy()
_GAP[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed."""
    width = values.dtype.itemsize
    return zstandard.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T.tobytes(), 1)


def _unpack(blob: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def tokenise(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(word numbers from 1, 0 between pieces and texts; distinct words)."""
    raw, ends = text_bytes(texts)
    raw = _LOWER[raw]
    inside = ~_GAP[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at_text = ends[:-1][ends[:-1] < len(raw)]
    first[at_text] |= inside[at_text]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.int32), pa.array([], pa.string())
    places = np.concatenate((starts, [len(raw)]))
    kept = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
    offsets = kept[places].astype(np.int32)  # slices are far below 2 GB
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[inside])).dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
    stops = np.concatenate(([0], np.cumsum(_STOP[raw], dtype=np.int32)))[starts]
    text = np.searchsorted(ends, starts, side="right")
    cut = np.flatnonzero((stops[1:] != stops[:-1]) | (text[1:] != text[:-1])) + 1
    return np.insert(codes, cut, 0), words.dictionary


def blocks(docs: DataFrame) -> DataFrame:
    """lang, n, words, codes: tokenised blocks of the documents' texts, one language each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=BLOCK_BYTES):
                texts, lang = texts_of(part), part.column("lang").cast(pa.string())
                for name in pc.unique(lang).to_pylist():
                    codes, words = tokenise(texts.filter(pc.equal(lang, name)))
                    if len(words):
                        yield pa.RecordBatch.from_arrays([
                            pa.array([name], pa.string()), pa.array([int(np.count_nonzero(codes))], pa.int64()),
                            pa.array([zstandard.compress("\n".join(words.to_pylist()).encode(), 3)], pa.binary()),
                            pa.array([_pack(codes)], pa.binary())], names=["lang", "n", "words", "codes"])
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"), "text")
    return rows.mapInArrow(run, "lang string, n long, words binary, codes binary")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, list[str]]]:
    """(lang, word numbers, words) of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            words = zstandard.decompress(batch.column("words")[i].as_py()).decode().split("\n")
            yield batch.column("lang")[i].as_py(), _unpack(batch.column("codes")[i].as_py(), np.int32), words


def word_counts(cut: DataFrame) -> DataFrame:
    """lang, phrase, f of every word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, codes, words in _opened(batches):
            counts = np.bincount(codes, minlength=len(words) + 1)[1:]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), pa.array(words), pa.array(counts)], names=["lang", "phrase", "f"])
    return cut.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _lang_seed(lang: str) -> np.uint64:
    return word_hashes(pa.array([lang]))[0]


def _held(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a hash's bit is set."""
    bit = hashes & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0


def _levels(lang: str, codes: np.ndarray, words: list[str], bitmaps: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words of the phrase, positions, hashes) for phrases of 2, 3, ... words whose parts' bits are all set.

    ``bitmaps`` are those of 1, 2, ... words; one more level than there are bitmaps is given.
    """
    with np.errstate(over="ignore"):
        by_word = np.concatenate(([np.uint64(0)], mix64(word_hashes(pa.array(words)) ^ _lang_seed(lang))))
        word = by_word[codes]
        known = _held(bitmaps[0], by_word)
        known[0] = False
        at, hashes = np.flatnonzero(known[codes]), None
        hashes = word[at]
        for k in range(2, len(bitmaps) + 2):
            if k > 2:
                keep = _held(bitmaps[k - 2], hashes)
                at, hashes = at[keep], hashes[keep]
            pair = np.flatnonzero(at[1:] == at[:-1] + 1)  # the phrases at i and i + 1 overlap in all words but two
            at, hashes = at[pair], hashes[pair]
            hashes = mix64(hashes * _STEP + word[at + k - 1])
            yield k, at, hashes


def _by_hash(hashes: np.ndarray, n_parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(hash partition, places of its hashes) of the partitions that have any."""
    part = (hashes >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(n_parts + 1))
    for k in np.flatnonzero(np.diff(edges)).tolist():
        yield k, order[edges[k]:edges[k + 1]]


def _together(rows: DataFrame, n_parts: int) -> DataFrame:
    """Rows dealt by (lang, part), to as many tasks as there are hash partitions."""
    return rows.repartition(max(n_parts, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "lang", "part")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[dict]]]:
    """((lang, part), its rows one by one) of rows that come in the order of these."""
    rows = (row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist())
    return groupby(rows, key=lambda row: (row["lang"], row["part"]))


def _summaries(cut: DataFrame, bitmaps, size: int, n_parts: int) -> DataFrame:
    """lang, part, mass, hashes, counts: phrases of ``size`` words of some blocks, by hash partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b.value for b in bitmaps]
        held: dict[str, list[np.ndarray]] = {}

        def packed() -> Iterator[pa.RecordBatch]:
            for lang, found in held.items():
                hashes, counts = np.unique(np.concatenate(found), return_counts=True)
                for part, rows in _by_hash(hashes, n_parts):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang]), pa.array([part], pa.int32()), pa.array([int(counts[rows].sum())], pa.int64()),
                        pa.array([hashes[rows].tobytes()], pa.binary()), pa.array([_pack(counts[rows].astype(np.uint32))], pa.binary())],
                        names=["lang", "part", "mass", "hashes", "counts"])
            held.clear()
        for lang, codes, words in _opened(batches):
            *_, (_, _, found) = _levels(lang, codes, words, tables)
            held.setdefault(lang, []).append(found)
            if sum(len(x) for found in held.values() for x in found) >= HELD_HASHES:
                yield from packed()
        yield from packed()
    return cut.select("lang", "words", "codes").mapInArrow(run, "lang string, part int, mass long, hashes binary, counts binary")


class Summary:
    """A Misra-Gries summary of weighted hashes that can be merged with others.

    ``taken`` is what was taken off every count: a hash counted f times holds at least f - taken.
    """

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, hashes: np.ndarray, counts: np.ndarray, taken: int = 0) -> None:
        keys, place = np.unique(np.concatenate((self.hashes, hashes)), return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, place, np.concatenate((self.counts, counts)))
        self.taken += taken
        if len(keys) > self.capacity:
            off = int(np.partition(sums, len(sums) - self.capacity - 1)[len(sums) - self.capacity - 1])
            self.taken += off
            keys, sums = keys[sums > off], sums[sums > off] - off
        self.hashes, self.counts = keys, sums

    def survivors(self, min_count: int) -> np.ndarray:
        return self.hashes[self.counts + self.taken >= min_count]


def _survivors(summaries: DataFrame, n_parts: int, min_count: int) -> DataFrame:
    """hash of every phrase that may occur ``min_count`` times: a Misra-Gries summary for each hash partition."""
    by_part = Window.partitionBy("lang", "part")  # a partition's summaries come together, and their mass before them
    rows = _together(summaries, n_parts).withColumn("total", F.sum("mass").over(by_part)).select("lang", "part", "total", "hashes", "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches):
            summary, waiting, size = None, [], 0
            for row in rows:
                if summary is None:
                    summary = Summary(row["total"] // min_count + 1)
                waiting.append((np.frombuffer(row["hashes"], np.uint64), _unpack(row["counts"], np.uint32).astype(np.int64)))
                size += len(waiting[-1][0])
                if size >= max(MERGE_AT, summary.capacity):
                    summary.merge(*map(np.concatenate, zip(*waiting)))
                    waiting, size = [], 0
            if waiting:
                summary.merge(*map(np.concatenate, zip(*waiting)))
            yield pa.RecordBatch.from_arrays([pa.array(summary.survivors(min_count).view(np.int64))], names=["hash"])
    return rows.mapInArrow(run, "hash long")


def _bitmap(survivors: DataFrame):
    """Bits of the survivors, at most ``MAX_BITS`` of them, for the tasks of the next pass."""
    n = survivors.count()
    bits = 1 << 10
    while bits < min(MAX_BITS, 16 * n):
        bits <<= 1
    bit = F.col("hash").bitwiseAND(F.lit(bits - 1))
    one = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    cells = survivors.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell")).agg(F.bit_or(one).alias("held"))
    table = np.zeros(bits // 64, np.int64)
    got = cells.toArrow()  # at most MAX_BITS / 64 rows
    table[got["cell"].to_numpy()] = got["held"].to_numpy()
    return survivors.sparkSession.sparkContext.broadcast(table.view(np.uint64))


def _word_survivors(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            seed = np.array([_lang_seed(x) for x in langs.dictionary.to_pylist()], np.uint64)[langs.indices.to_numpy(zero_copy_only=False)]
            with np.errstate(over="ignore"):
                hashes = mix64(word_hashes(batch.column("phrase")) ^ seed)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], names=["hash"])
    return words.select("lang", "phrase").mapInArrow(run, "hash long")


def _distinct_phrases(codes: np.ndarray, at: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers of the distinct phrases at ``at``, how often each occurs)."""
    phrases = codes[at[:, None] + np.arange(size)]
    _, first, place, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    if (phrases[first][place] == phrases).all():
        return phrases[first], counts
    return np.unique(phrases, axis=0, return_counts=True)  # two phrases have one hash


def _phrase_counts(cut: DataFrame, bitmaps, n_parts: int, min_count: int) -> DataFrame:
    """lang, phrase, size, f of the phrases that occur ``min_count`` times, counted by their words.

    Tasks add up the phrases whose bits are set at every level and send them packed to the
    phrase's hash partition, which holds the survivors' part and those that share their bits."""
    def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b.value for b in bitmaps]
        held: dict[str, Counter] = {}

        def packed() -> Iterator[pa.RecordBatch]:
            for lang, counter in held.items():
                phrases = np.array(list(counter), object)
                counts = np.fromiter(counter.values(), np.int64, len(phrases))
                for part, rows in _by_hash(word_hashes(pa.array(phrases, pa.string())), n_parts):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang]), pa.array([part], pa.int32()), pa.array([zstandard.compress("\n".join(phrases[rows]).encode(), 1)], pa.binary()),
                        pa.array([_pack(counts[rows])], pa.binary())], names=["lang", "part", "phrases", "counts"])
            held.clear()
        for lang, codes, words in _opened(batches):
            counter = held.setdefault(lang, Counter())
            for size, at, hashes in _levels(lang, codes, words, tables[:-1]):
                keep = _held(tables[size - 1], hashes)
                phrases, counts = _distinct_phrases(codes, at[keep], hashes[keep], size)
                for phrase, n in zip(phrases.tolist(), counts.tolist()):
                    counter[" ".join([words[c - 1] for c in phrase])] += n
            if sum(map(len, held.values())) >= HELD_PHRASES:
                yield from packed()
        yield from packed()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, _), rows in _groups(batches):
            counter = Counter()
            for row in rows:
                for phrase, n in zip(zstandard.decompress(row["phrases"]).decode().split("\n"), _unpack(row["counts"], np.int64).tolist()):
                    counter[phrase] += n
            found = [(x, n) for x, n in counter.items() if n >= min_count]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(found), pa.string()), pa.array([x for x, _ in found], pa.string()),
                pa.array([x.count(" ") + 1 for x, _ in found], pa.int32()), pa.array([n for _, n in found], pa.int64())],
                names=["lang", "phrase", "size", "f"])
    sent = cut.select("lang", "words", "codes").mapInArrow(by_part, "lang string, part int, phrases binary, counts binary")
    return (_together(sent, n_parts).sortWithinPartitions("lang", "part").mapInArrow(total, "lang string, phrase string, size int, f long"))


def _part(first, last):
    """Words ``first`` to ``last`` (columns, from 1) of the phrase."""
    return F.array_join(F.slice("words", first, last - first + 1), " ")


def scored(candidates: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with the l, r and score of their lowest-scoring cut."""
    parts = candidates.select("lang", "phrase", "f").unionByName(words.select("lang", "phrase", "f"))
    split = candidates.withColumn("words", F.split("phrase", " "))
    cuts = split.select("lang", "phrase", F.col("f").alias("a"), "words", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("size")).alias("right"))
    # a part occurs at least as often as the phrase, so it is a candidate or a frequent word
    cuts = (cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
            .join(totals, "lang"))
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    cuts = cuts.withColumn("above", wide["a"] * wide["n"] * F.lit(1000).cast("decimal(4,0)")).withColumn("below", wide["l"] * wide["r"])
    cuts = cuts.withColumn("score", F.expr("above div below"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a", "n").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def absorbed(candidates: DataFrame) -> DataFrame:
    """lang, phrase of candidates that occur inside one longer candidate only.

    A longer candidate that holds a phrase and is as frequent has one of one word more that
    is too, so each looks only at its two parts that lack one word.
    """
    longer = candidates.where("size > 2").withColumn("words", F.split("phrase", " "))
    inner = F.explode(F.array(_part(F.lit(1), F.col("size") - 1), _part(F.lit(2), F.col("size")))).alias("phrase")
    return longer.select("lang", inner, "f").distinct()


def ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language; its rows are first ranked in parts."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    spread = rows.withColumn("spread", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    some = spread.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "spread").orderBy(*order))).where(F.col("rank") <= top)
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top).drop("spread"))


def mine(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's strongest collocations."""
    cut = materialize(blocks(docs), "phrase-blocks")
    totals = cut.groupBy("lang").agg(F.sum("n").alias("n"))
    n_words = cut.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_parts = max(1, -(-n_words // PARTITION_MASS))
    words = materialize(word_counts(cut).where(F.col("f") >= min_count), "phrase-words")
    bitmaps = [_bitmap(materialize(_word_survivors(words), "phrase-survivors"))]
    for size in range(2, max_words + 1):
        survivors = _survivors(_summaries(cut, bitmaps, size, n_parts), n_parts, min_count)
        bitmaps.append(_bitmap(materialize(survivors, "phrase-survivors")))
    candidates = materialize(_phrase_counts(cut, bitmaps, n_parts, min_count), "phrase-candidates")
    out = scored(candidates, words, totals)
    inside = absorbed(candidates).withColumnRenamed("f", "a")
    return ranked(out.join(inside, ["lang", "phrase", "a"], "left_anti"), top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlens.llm.common import documents
    return mine(documents(spark, sf_dir))
