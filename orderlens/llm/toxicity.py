"""Toxicity by class log odds of n-grams with a Kneser-Ney backoff.

Two bigram models, toxic and ordinary, are trained on labelled documents. They are not the
normalised Kneser-Ney models P(w|h) of each class: those were tried and scored far worse (README,
deviations). As Kneser-Ney counts types and not tokens, an n-gram counts once in a document, however often it is
repeated there. Each level discounts its counts and backs off to the level below: class
bigrams to class unigrams, and those to counts both classes share, dealt to the classes by
their share of all documents. The discount is the absolute one plus ``REACH`` standard
errors of the count, so a rare expression gets the same probability from both models,
however small one class is, and only n-grams that a class truly favours tell them apart.
A document is scored by the
difference of its two log-likelihoods, normalised by its length, and a logistic curve
fitted on labelled documents outside the counts turns that into a probability.

All labelled rows outside the held-out fold are learned from: ``COUNT_SHARE`` percent of them
give counts, the rest the curve. Counting runs in Spark, and so do the sums of each Newton step of
the curve. The model goes to the tasks as arrays: the hashed words in ``MIN_COUNT`` documents or
more (a vocabulary), and those of their bigrams that one class favours; any other bigram scores as its
second word does, known or not.

Defined cases: null text scores as the empty one, which has no evidence and gets the
curve's value at 0; null labels are not learned from; repeated rows are scored separately;
with one class missing among the labels every score is that class's share; an empty table
gives an empty result; other columns are carried only by ``score_documents``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import append_columns, id_crc32, mix64, row_numbers, row_sums, slices, split_words, texts_of, word_hashes

COUNT_SHARE = 70
MIN_COUNT = 5
DISCOUNT = 0.75
SHARED = 2
REACH = 3
THRESHOLD = 0.3
U64 = np.uint64
_BITMAP = 22
ID_BITS = 24


def normal_words(words: pa.Array) -> pa.Array:
    """Lower case, without marks at either end; a word of marks only stays as it is."""
    bare = pc.replace_substring_regex(pc.utf8_lower(words), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    return pc.if_else(pc.equal(pc.binary_length(bare), 0), words, bare)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row offsets, hash of each normal word)."""
    offsets, codes, words = split_words(texts)
    return offsets, word_hashes(normal_words(words))[codes] if len(codes) else np.zeros(0, U64)


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix64(left * U64(0x9E3779B97F4A7C15) + right)


def known(table: np.ndarray, bitmap: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in ``keys`` that are in the sorted ``table``, their places there)."""
    if not len(table):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    maybe = np.flatnonzero(bitmap[keys >> U64(64 - _BITMAP)])
    at = np.minimum(np.searchsorted(table, keys[maybe]), len(table) - 1)
    hit = table[at] == keys[maybe]
    return maybe[hit], at[hit]


def bitmap_of(table: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << _BITMAP, bool)
    out[table >> U64(64 - _BITMAP)] = True
    return out


@dataclass
class Model:
    """Sorted n-gram hashes with log P(toxic) - log P(ordinary), and the logistic curve."""

    words: np.ndarray
    word_gain: np.ndarray      # a known word where its bigram is unknown
    unknown_gain: float        # any other word
    pairs: np.ndarray
    pair_gain: np.ndarray
    curve: np.ndarray          # weights of llr / n, llr / sqrt(n), and a constant

    def log_ratio(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Per text: (log-likelihood difference, words)."""
        offsets, words = hashed_words(texts)
        gain = np.full(len(words), self.unknown_gain)
        at, place = known(self.words, self._word_map, words)
        gain[at] = self.word_gain[place]
        row = row_numbers(offsets)
        same = row[1:] == row[:-1] if len(row) else np.zeros(0, bool)
        at, place = known(self.pairs, self._pair_map, pair_hash(words[:-1], words[1:]))
        inside = same[at]
        gain[at[inside] + 1] = self.pair_gain[place[inside]]
        return row_sums(gain, offsets), np.diff(offsets)

    def __post_init__(self):
        self._word_map, self._pair_map = bitmap_of(self.words), bitmap_of(self.pairs)

    def score(self, texts: pa.Array) -> np.ndarray:
        ratio, n = self.log_ratio(texts)
        return 1 / (1 + np.exp(-np.clip(curve_inputs(ratio, n) @ self.curve, -30, 30)))


def curve_inputs(ratio: np.ndarray, n: np.ndarray) -> np.ndarray:
    n = np.maximum(n, 1)
    return np.stack([10 * ratio / n, ratio / np.sqrt(n), np.ones(len(n))], axis=1)


def newton_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The Hessian of the rows, then their gradient, in one array."""
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return np.concatenate((((x * (p * (1 - p))[:, None]).T @ x).ravel(), x.T @ (y - p)))


def newton(sums: Callable[[np.ndarray], np.ndarray], n: int, size: int, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Logistic regression on ``n`` rows by Newton steps from their ``newton_sums``, lightly shrunk so that separable data converge."""
    w = np.zeros(size)
    penalty = ridge * n * np.eye(size)
    penalty[-1, -1] = 1e-6
    for _ in range(rounds):
        found = sums(w)
        hessian, gradient = found[:size * size].reshape(size, size), found[size * size:]
        step = np.linalg.solve(hessian + penalty, gradient - penalty @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return newton(lambda w: newton_sums(x, y, w), len(y), x.shape[1])


def fit_curve(rows: DataFrame) -> np.ndarray:
    """The curve of rows (ratio, n, label). Each step adds up their sums, so they are read several
    times; pass a written table."""
    size = curve_inputs(np.zeros(1), np.ones(1)).shape[1]

    def sums(w: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size * size + size)
            for batch in batches:
                ratio, n, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("ratio", "n", "label"))
                total += newton_sums(curve_inputs(ratio, n), label.astype(float), w)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "x"])
        got = rows.select("ratio", "n", "label").mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x")).collect()  # a row per sum
        return np.array([x for _, x in sorted(got)])
    return newton(sums, rows.count(), size)


def usable_marks(marks: DataFrame, label: str = "toxic", fold: int = 4, held: int = 2) -> DataFrame:
    """doc_id, label: the distinct labels that may be learned from."""
    usable = marks.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (id_crc32(F.col("doc_id")) % fold != held))
    return usable.select("doc_id", F.col(label).cast("int").alias("label")).distinct()


def counted(doc_id: str = "doc_id") -> Column:
    """Whether a labelled document gives counts, and not the curve."""
    return F.pmod(F.xxhash64(F.lit("part"), doc_id), F.lit(100)) < COUNT_SHARE


def with_ids_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id may be one of ``ids``: all that are, and by chance of the hash some
    others, so that a join on the id need not shuffle every text. The ids go round as a bitmap of
    2 ** ID_BITS hashed places, 64 in a row, which is bounded at any size."""
    kind = docs.schema["doc_id"].dataType
    if kind != ids.schema["doc_id"].dataType or not isinstance(kind, (T.IntegralType, T.StringType)):
        return docs  # equal ids of other types may hash apart
    place = F.shiftrightunsigned(F.xxhash64(F.lit("id"), "doc_id"), 64 - ID_BITS)
    bit = F.expr("shiftleft(1L, CAST(__place & 63 AS INT))")
    found = ids.select(place.alias("__place")).groupBy(F.shiftright("__place", 6).alias("__row")).agg(F.bit_or(bit).alias("__bits"))
    placed = docs.withColumn("__place", place).withColumn("__row", F.shiftright("__place", 6))
    return placed.join(F.broadcast(found), "__row").where(F.col("__bits").bitwiseAND(bit) != 0).drop("__row", "__place", "__bits")


def labelled(docs: DataFrame, marks: DataFrame, label: str = "toxic", fold: int = 4, held: int = 2, sample: int | None = None) -> DataFrame:
    """text, label, counts (or curve) of the labelled rows, held-out ones never among them. With
    ``sample`` at most so many ids of each class, those of the smallest hashes."""
    usable = usable_marks(marks, label, fold, held)
    if sample is None:
        return _joined(docs.select("doc_id", "text"), usable)
    spread, rows = F.xxhash64(F.lit("fit"), "doc_id"), None
    for value in (0, 1):  # a top-k, not a window over a class
        part = usable.where(F.col("label") == value).orderBy(spread, "doc_id").limit(sample)
        rows = part if rows is None else rows.unionByName(part)
    usable = F.broadcast(rows)  # two integers for each of at most 2 * sample rows
    return docs.select("doc_id", "text").join(usable, "doc_id").select("doc_id", "text", "label", counted().alias("counts"))


def _joined(docs: DataFrame, usable: DataFrame) -> DataFrame:
    """``docs`` with label and counts of each usable mark. Joined by shuffle at every size, so that
    labels are never sent whole to a task."""
    rows = with_ids_of(docs, usable).join(usable.hint("shuffle_hash"), "doc_id")
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], "label", counted().alias("counts"))


def ngram_counts(rows: DataFrame) -> DataFrame:
    """left (null: unigram), right, n0, n1: documents of each class that hold the hashed n-gram."""
    schema = "left long, right long, n0 long, n1 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                offsets, words = hashed_words(texts_of(part))
                row = row_numbers(offsets)
                toxic = part.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
                same = row[1:] == row[:-1] if len(row) else np.zeros(0, bool)
                pair = pd.DataFrame({"row": row[1:][same], "left": words[:-1][same].view(np.int64), "right": words[1:][same].view(np.int64)})
                pair = pair.drop_duplicates()
                pair = pair.assign(n1=toxic[pair.row]).groupby(["left", "right"], sort=False).n1.agg(["size", "sum"]).reset_index()
                one = pd.DataFrame({"row": row, "right": words.view(np.int64)}).drop_duplicates()
                one = one.assign(n1=toxic[one.row]).groupby("right", sort=False).n1.agg(["size", "sum"]).reset_index()
                for x, left in ((pair, pair.get("left")), (one, None)):
                    n1 = x["sum"].to_numpy(np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.nulls(len(x), pa.int64()) if left is None else pa.array(left.to_numpy(np.int64)),
                        pa.array(x["right"].to_numpy(np.int64)), pa.array(x["size"].to_numpy(np.int64) - n1), pa.array(n1)],
                        names=["left", "right", "n0", "n1"])
    return rows.mapInArrow(run, schema).groupBy("left", "right").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def fit(docs: DataFrame, marks: DataFrame, label: str = "toxic", fold: int = 4, held: int = 2) -> Model:
    """Train both models and the curve on all labelled rows outside the held-out fold."""
    from orderlens.sources.files import materialize
    usable = materialize(usable_marks(marks, label, fold, held), "toxic-labels")
    texts = docs.select("doc_id", "text")
    rows = _joined(texts, usable).where("counts")
    total = F.col("n0") + F.col("n1")
    counts = ngram_counts(rows.select("text", "label"))
    counts = materialize(counts.where(F.col("left").isNull() | (total >= MIN_COUNT)), "toxic-ngrams")  # rarer bigrams tell nothing
    ones = counts.where("left is null")
    words = ones.where(total >= MIN_COUNT).select(F.col("right").alias("word"), "n0", "n1").toArrow().to_pandas()  # a row per word of the vocabulary
    rest = ones.where(total < MIN_COUNT).agg(F.sum("n0"), F.sum("n1")).first()
    by_class = dict(rows.groupBy("label").count().collect())
    docs_of = [by_class.get(0, 0), by_class.get(1, 0)]
    model = _words_model(words, docs_of, [rest[0] or 0, rest[1] or 0])
    if min(docs_of):
        pairs = counts.where("left is not null").select("left", "right", "n0", "n1")
        found = _favoured(pairs, model, docs_of[1] / docs_of[0]).toArrow().to_pandas()
        hashed = found.pair.to_numpy(np.int64).view(U64)
        order = np.argsort(hashed)
        model = Model(model.words, model.word_gain, model.unknown_gain, hashed[order], found.gain.to_numpy(float)[order], model.curve)
    return _with_curve(model, texts, usable)


def _kept(n1: np.ndarray, n0: np.ndarray, share: np.ndarray) -> np.ndarray:
    """What a count of toxic documents exceeds its expected share by, less the discount."""
    total = n0 + n1
    excess = n1 - total * share
    return np.sign(excess) * np.maximum(np.abs(excess) - DISCOUNT - REACH * np.sqrt(total * share * (1 - share)), 0)


def _share(prior: np.ndarray, odds: float) -> np.ndarray:
    return odds * np.exp(prior) / (1 + odds * np.exp(prior))


def _log_odds(n1: np.ndarray, n0: np.ndarray, prior: np.ndarray, odds: float) -> np.ndarray:
    """log P(n-gram | toxic) - log P(n-gram | ordinary) from discounted counts and the backoff's own log ratio ``prior``."""
    share, total = _share(prior, odds), n0 + n1
    kept = _kept(n1, n0, share)
    toxic = (total + SHARED) * share + kept
    ordinary = (total + SHARED) * (1 - share) - kept
    return np.log(toxic) - np.log(ordinary) - np.log(odds)


def _words_model(words: pd.DataFrame, docs: list[int], rest: list[int]) -> Model:
    """The model of the words alone, without bigrams and curve."""
    words = words.assign(key=words.word.to_numpy(np.int64).view(U64)).sort_values("key")
    none = np.zeros(0)
    if not min(docs):
        return Model(np.zeros(0, U64), none, 0.0, np.zeros(0, U64), none, np.zeros(3))
    odds = docs[1] / docs[0]
    gain = _log_odds(words.n1.to_numpy(float), words.n0.to_numpy(float), np.zeros(len(words)), odds)
    unknown = _log_odds(np.array([float(rest[1])]), np.array([float(rest[0])]), np.zeros(1), odds)[0]
    return Model(words.key.to_numpy(U64), gain, float(unknown), np.zeros(0, U64), none, np.zeros(3))


def _favoured(pairs: DataFrame, model: Model, odds: float) -> DataFrame:
    """pair, gain of the bigrams of known words that one class favours. Where nothing is left of the
    excess, the log odds are the backoff's, and the gain is that of the second word alone."""
    shared = pairs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            left, right = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64).view(U64) for c in ("left", "right"))
            n0, n1 = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n0", "n1"))
            both = np.isin(left, m.words) & np.isin(right, m.words)
            left, right, n0, n1 = left[both], right[both], n0[both], n1[both]
            first, second = (m.word_gain[np.searchsorted(m.words, x)] for x in (left, right))
            told = _kept(n1, n0, _share(first + second, odds)) != 0
            gain = _log_odds(n1, n0, first + second, odds) - first
            yield pa.RecordBatch.from_arrays([pa.array(pair_hash(left, right)[told].view(np.int64)), pa.array(gain[told])], names=["pair", "gain"])
    return pairs.mapInArrow(run, "pair long, gain double")


def _with_curve(model: Model, texts: DataFrame, usable: DataFrame) -> Model:
    """Fit the curve on the labelled rows that gave no counts (all of them, where those lack a class).
    Texts are measured where they are read; only ids and measures meet the labels."""
    from orderlens.sources.files import materialize
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ratio, n = shared.value.log_ratio(texts_of(part))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ratio), pa.array(n.astype(np.int64))], names=["doc_id", "ratio", "n"])
    schema = T.StructType([texts.schema["doc_id"], T.StructField("ratio", T.DoubleType()), T.StructField("n", T.LongType())])
    for part in (texts.where(~counted()), texts):
        measured = with_ids_of(part, usable).mapInArrow(run, schema)
        curve = materialize(measured.join(usable.hint("shuffle_hash"), "doc_id").select("ratio", "n", "label"), "toxic-ratios")
        sizes = dict(curve.groupBy("label").count().collect())  # a row per class
        if len(sizes) == 2:
            model.curve = fit_curve(curve)
            return model
    share = sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.0
    model.curve = np.array([0.0, 0.0, np.log((share + 1e-6) / (1 - share + 1e-6))])
    return model


def score_documents(docs: DataFrame, model: Model, name: str = "__toxicity") -> DataFrame:
    """``docs`` with the score of its whole text in a column ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield append_columns(part, **{name: shared.value.score(texts_of(part))})
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def filter_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    return score_documents(docs, model).where(F.col("__toxicity") < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlens.llm.common import documents, labels
    docs = documents(spark, sf_dir)
    model = fit(docs, labels(spark, sf_dir))
    return score_documents(docs.select("doc_id", "text"), model, "score").select(
        "doc_id", (id_crc32(F.col("doc_id")) % 4 == 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
