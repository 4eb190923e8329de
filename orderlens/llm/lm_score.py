"""Cross-entropy difference of two matched n-gram models.

A target model is counted on the documents labelled good (quality 1, toxic 0), a background
model on all documents. They share one vocabulary (every word that occurs ``MIN_COUNT`` times
in the corpus; all others are one unknown word), one order, one smoothing and one mass:
background counts are scaled to the target's number of words. A bigram backs off to its
unigram, and that to an even chance. A document's score is the mean over its words of
background loss less target loss: above 0, it reads more like the target. A document that was
counted is taken out of the counts while it is scored, so that no document is compared with
itself.

Nothing is capped and no model is held anywhere whole. Documents are cut once into blocks of
bounded text size, kept in buckets of their number, so that what comes back to a block finds it
without moving it. A block sends its distinct words with their counts, packed by hash
partition; a partition (about ``PARTITION_KEYS`` entries) adds up what all blocks sent and
answers each block in the order of its own keys. Then the same for bigrams of vocabulary words.
Keys are 64-bit hashes; a frequent key is one entry of each block. With the answers a block
scores its documents.

Defined cases: null and empty texts score 0 with no words; null ids and null labels are in
the background only; repeated rows count as often as they occur, each leaving out itself
alone; rows whose ``counted`` is false give no counts and are scored like new documents;
without labelled documents both models are the same and all scores are 0; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import mix64, row_numbers, row_sums, slices, split_words, texts_of, word_hashes
from orderlens.llm.toxicity import normal_words
from orderlens.sources.bucketed import bucketed
from orderlens.sources.files import materialize

MIN_COUNT = 4
BACKOFF = 100.0
UNIGRAM_BACKOFF = 100.0
BLOCK_BYTES = 8 << 20
#: Entries of a hash partition, about.
PARTITION_KEYS = 1_000_000
#: Ids of target documents that are broadcast at most (8 bytes each); above, the join shuffles.
BROADCAST_ROWS = 1_000_000
U64 = np.uint64
START, UNKNOWN = U64(1), U64(2)
_STEP = U64(0x9E3779B97F4A7C15)
_SENT = "block long, part int, keys binary, counts binary"
_ANSWER = "block long, part int, sums binary, summary array<long>"


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed."""
    wide = np.ascontiguousarray(values)
    return zstandard.compress(wide.view(np.uint8).reshape(-1, wide.dtype.itemsize).T.tobytes(), 3)


def _unpack(blob: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _sums(places: np.ndarray, size: int, weights: list[np.ndarray]) -> np.ndarray:
    """One row per weight: its sum at each place."""
    return np.stack([np.bincount(places, w, minlength=size) for w in weights]).astype(np.int64)


@dataclass
class Block:
    """Documents by numbered words: the words' keys ascending, and in which model's counts each document is."""

    lengths: np.ndarray
    codes: np.ndarray
    keys: np.ndarray
    inside: np.ndarray     # rows 0 (background) and 1 (target)

    def __post_init__(self):
        self.offsets = np.concatenate(([0], np.cumsum(self.lengths)))
        self.rows = row_numbers(self.offsets)
        self.first = np.zeros(len(self.codes), bool)
        self.first[self.offsets[:-1][self.lengths > 0]] = True

    def word_counts(self) -> np.ndarray:
        """Per word: occurrences in both models, and those that another word follows."""
        weights = [x[self.rows].astype(float) for x in self.inside]
        followed = ~np.append(self.first[1:], True) if len(self.codes) else self.first
        return _sums(self.codes, len(self.keys), [*weights, *[w * followed for w in weights]])

    def bigrams(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distinct bigram keys ascending, the place of each word's bigram among them)."""
        word = np.where(known, self.keys, UNKNOWN)[self.codes]
        before = np.where(self.first, START, np.concatenate((word[:1], word[:-1])))
        with np.errstate(over="ignore"):
            return np.unique(mix64(before * _STEP + word), return_inverse=True)

    def pair_counts(self, places: np.ndarray, size: int) -> np.ndarray:
        return _sums(places, size, [x[self.rows].astype(float) for x in self.inside])


def _opened(row) -> Block:
    return Block(_unpack(row.lengths, np.uint32).astype(np.int64), _unpack(row.codes, np.uint32).astype(np.int64), _unpack(row.keys, np.uint64),
                 _unpack(row.inside, np.uint8).reshape(2, -1).astype(bool))


def blocks(marked: DataFrame) -> DataFrame:
    """block, doc_ids, lengths, codes, keys, inside of all documents, in buckets of the block."""
    schema = T.StructType([T.StructField("doc_ids", T.ArrayType(marked.schema["doc_id"].dataType)),
                           *[T.StructField(c, T.BinaryType()) for c in ("lengths", "codes", "keys", "inside")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=BLOCK_BYTES):
                offsets, codes, words = split_words(texts_of(part))
                keys, number = np.unique(word_hashes(normal_words(words)) if len(words) else np.zeros(0, U64), return_inverse=True)
                counted, target = (part.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("counted", "in_target"))
                values = [_pack(np.diff(offsets).astype(np.uint32)), _pack((number[codes] if len(codes) else codes).astype(np.uint32)), _pack(keys),
                          _pack(np.concatenate((counted, counted & target)).astype(np.uint8))]
                yield pa.RecordBatch.from_arrays([pa.array([part.column("doc_id").to_pylist()], pa.list_(part.column("doc_id").type)),
                                                  *[pa.array([v], pa.binary()) for v in values]], names=schema.names)
    cut = marked.select("doc_id", "text", "in_target", "counted").mapInArrow(run, schema)
    n = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bucketed(cut.withColumn("block", F.monotonically_increasing_id()).repartition(n, "block"), "block", n, "lm_blocks")


def _sent(block: int, keys: np.ndarray, counts: np.ndarray, n_parts: int) -> list[tuple]:
    """A block's keys and counts by hash partition; ascending keys make ascending partitions."""
    edges = np.searchsorted((keys >> U64(32)) * U64(n_parts) >> U64(32), np.arange(n_parts + 1))
    return [(block, p, _pack(keys[edges[p]:edges[p + 1]]), _pack(counts[:, edges[p]:edges[p + 1]].astype(np.uint32).ravel()))
            for p in np.flatnonzero(np.diff(edges)).tolist()]


def _answered(sent: DataFrame, columns: int, least: int) -> DataFrame:
    """block, part, sums: the corpus' sums of each block's keys in their order, written. The first row
    of a partition has its ``summary``: keys whose first sum is ``least`` or more, the sums of
    the others, and the sums of all."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        lists = [_unpack(x, np.uint64) for x in rows["keys"]]
        counts = np.concatenate([_unpack(x, np.uint32).reshape(columns, -1) for x in rows["counts"]], axis=1)
        keys, place = np.unique(np.concatenate(lists), return_inverse=True)
        sums = _sums(place, len(keys), list(counts))
        rare = sums[0] < least
        summary = [int((~rare).sum()), *sums[:, rare].sum(axis=1).tolist(), *sums.sum(axis=1).tolist()]
        ends = np.cumsum([len(x) for x in lists])
        back = [_pack(sums[:, place[e - len(x):e]].ravel()) for x, e in zip(lists, ends)]
        return pd.DataFrame({"block": rows["block"], "part": rows["part"], "sums": back, "summary": [summary, *[None] * (len(rows) - 1)]})
    return materialize(sent.groupBy("part").applyInPandas(run, _ANSWER), "lm-answers")


def _sums_of(answers: pd.DataFrame, columns: int) -> np.ndarray:
    """The block's sums, of all partitions, in the order of its keys."""
    parts = [_unpack(x, np.int64).reshape(columns, -1) for x in answers.sort_values("part")["sums"]]
    return np.concatenate(parts, axis=1) if parts else np.zeros((columns, 0), np.int64)


@dataclass
class Corpus:
    """What all blocks need of the whole corpus: the vocabulary's size, and per model (background,
    target) the unknown word's occurrences, those that a word follows, and all words and starts."""

    size: int
    unknown: tuple
    unknown_followed: tuple
    words: tuple
    starts: tuple

    @classmethod
    def of(cls, summary: list[int]) -> "Corpus":
        size, rare, every = summary[0], summary[1:5], summary[5:9]
        return cls(size, tuple(rare[:2]), tuple(rare[2:]), tuple(every[:2]), (every[0] - every[2], every[1] - every[3]))


def _own(places: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """For each word how often its place occurs in its row."""
    _, where, n = np.unique(rows * size + places, return_inverse=True, return_counts=True)
    return n[where]


def losses(block: Block, words: np.ndarray, pairs: np.ndarray, corpus: Corpus) -> list[np.ndarray]:
    """Per model (background, target) the loss of each document, in nats. ``words`` and ``pairs``
    are the corpus' sums of the block's words and bigrams."""
    known = words[0] >= MIN_COUNT if len(block.keys) else np.zeros(0, bool)
    number = np.where(known, np.arange(len(known)), len(known))  # one number for all unknown words
    word = number[block.codes] if len(block.codes) else block.codes
    before = np.where(block.first, len(known) + 1, np.concatenate((word[:1], word[:-1])))
    _, place = block.bigrams(known)
    own = [_own(x, block.rows, len(known) + 2) for x in (word, before)] + [_own(place, block.rows, pairs.shape[1])]
    same, out = not corpus.words[1], []
    for m in (0, 1):
        k = 0 if same else m
        scale = 1.0 if same or k else corpus.words[1] / corpus.words[0]
        inside = block.inside[k][block.rows]
        unigram = np.append(words[k], corpus.unknown[k])[word]
        history = np.concatenate((words[2 + k], [corpus.unknown_followed[k], corpus.starts[k]]))[before]
        unigram, history, pair = (np.maximum(scale * (x - inside * o), 0) for x, o in zip((unigram, history, pairs[k][place]), own))
        mass = np.maximum(scale * (corpus.words[k] - inside * block.lengths[block.rows]), 0)
        unigram = (unigram + UNIGRAM_BACKOFF / (corpus.size + 1)) / (mass + UNIGRAM_BACKOFF)
        out.append(row_sums(-np.log((pair + BACKOFF * unigram) / (history + BACKOFF)), block.offsets))
    return out


def with_target(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """doc_id, text, in_target of all documents."""
    good = marks.where((F.col("quality") == 1) & (F.col("toxic") == 0) & F.col("doc_id").isNotNull())
    good = materialize(good.select("doc_id", F.lit(True).alias("in_target")).distinct(), "lm-target")
    small = good.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = docs.select("doc_id", "text").join(F.broadcast(good) if small else good, "doc_id", "left")
    return joined.withColumn("in_target", F.coalesce("in_target", F.lit(False)))


def score_documents(marked: DataFrame) -> DataFrame:
    """doc_id, n_words, background_loss, target_loss (per word), score of every document.

    ``marked`` has doc_id, text and in_target, and may have ``counted``: false for documents that
    are to be scored without being counted.
    """
    if "counted" not in marked.columns:
        marked = marked.withColumn("counted", F.lit(True))
    cut = blocks(marked)
    entries = cut.agg(F.coalesce(F.sum(F.octet_length("codes")), F.lit(0))).first()[0]  # about a byte and a half for each word
    n_parts = max(1, -(-entries // PARTITION_KEYS))

    def words_sent(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for row in frame.itertuples(index=False):
                block = _opened(row)
                yield pd.DataFrame(_sent(row.block, block.keys, block.word_counts(), n_parts), columns=["block", "part", "keys", "counts"])
    word_sums = _answered(cut.drop("doc_ids").mapInPandas(words_sent, _SENT), 4, MIN_COUNT)
    summary = word_sums.where("summary is not null").agg(*[F.coalesce(F.sum(F.get("summary", F.lit(i))), F.lit(0)) for i in range(9)]).first()
    corpus = Corpus.of(list(summary))

    def pairs_sent(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in own.itertuples(index=False):
            block = _opened(row)
            if len(block.keys):
                keys, place = block.bigrams(_sums_of(answers, 4)[0] >= MIN_COUNT)
                out += _sent(row.block, keys, block.pair_counts(place, len(keys)), n_parts)
        return pd.DataFrame(out, columns=["block", "part", "keys", "counts"])
    sent = cut.drop("doc_ids").groupBy("block").cogroup(word_sums.groupBy("block")).applyInPandas(pairs_sent, _SENT)
    pair_sums = _answered(sent, 2, 1)
    schema = T.StructType([marked.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           *[T.StructField(x, T.DoubleType()) for x in ("background_loss", "target_loss", "score")]])

    def scored(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in own.itertuples(index=False):
            block = _opened(row)
            background, target = losses(block, _sums_of(answers[answers["kind"] == 0], 4), _sums_of(answers[answers["kind"] == 1], 2), corpus)
            per = np.maximum(block.lengths, 1)
            out.append(pd.DataFrame({"doc_id": pd.Series(list(row.doc_ids), dtype=object), "n_words": block.lengths, "background_loss": background / per,
                                     "target_loss": target / per, "score": (background - target) / per}))
        return pd.concat(out) if out else pd.DataFrame(columns=schema.names)
    answers = word_sums.select("block", F.lit(0).alias("kind"), "part", "sums").unionByName(pair_sums.select("block", F.lit(1).alias("kind"), "part", "sums"))
    return cut.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(scored, schema)


def op7_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlens.llm.common import documents, labels
    return score_documents(with_target(documents(spark, sf_dir), labels(spark, sf_dir)))
