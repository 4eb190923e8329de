"""Document quality by a linear-chain conditional random field over lines.

Every line with a word gets bounded features (lengths, shares of symbols, capitals, digits
and repeated words, and the like), each cut into quantile bins, and those of the lines
before and after it. A chain of two states, bad and good, is trained on labelled documents,
whose lines bear the document's label. A document is scored by forward-backward: the
marginal chance of "good" of its lines, weighted by their length, and a logistic curve
fitted on labelled documents outside the chain's training.

Labelled rows: at most ``SAMPLE`` of each label (a documented bound; the smallest hashes of
their ids) of at most ``FIT_LINES`` lines each; of them ``CHAIN_SHARE`` percent train the
chain and the others the curve. Scoring reads whole texts of any length: each step of
the recursion runs for all documents of a slice at once.

Defined cases: null and empty texts, and texts of blank lines, have no evidence and get
the curve's value at an even chance; null labels are not learned from; repeated rows are
scored separately; with one label missing every score is that label's share; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import append_columns, count_bytes, id_crc32, in_repeated_window, row_numbers, row_sums, slices, split_words, text_bytes, texts_of
from orderlens.llm.toxicity import labelled, logistic

SAMPLE = 2500
CHAIN_SHARE = 70
FIT_LINES = 400
BINS = 10
ROUNDS = 120
RIDGE = 1e-3
_BYTE = np.arange(256)
_SYMBOL = np.isin(_BYTE, list(b"#*$%&|<>"))
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_MARK = np.isin(_BYTE, list(b"!?\"'();:-_/\\=@~^[]{}"))
FEATURES = ("chars", "words", "word_length", "symbols", "capitals", "digits", "marks", "same_as_last_word", "said_before_in_line",
            "repeated_in_text", "short_words", "line_seen_before", "ends_sentence", "lines")


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line offsets of each text, characters of each line, features) over the lines with a word."""
    parts = pc.split_pattern(texts, "\n")
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    flat = parts.flatten()
    worded = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0).to_numpy(zero_copy_only=False)
    lines, doc = flat.filter(pa.array(worded)), doc[worded]
    offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(texts)))))
    if not len(lines):
        return offsets, np.zeros(0), np.zeros((0, len(FEATURES)))
    at, codes, words = split_words(lines)
    n = np.diff(at).astype(float)
    chars = pc.utf8_length(lines).to_numpy(zero_copy_only=False).astype(float)
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False)[codes]
    raw, ends = text_bytes(lines)
    symbols, capitals, digits, marks = (count_bytes(raw, ends, table) / chars for table in (_SYMBOL, _UPPER, _DIGIT, _MARK))
    line = row_numbers(at)
    again = np.concatenate(([False], (codes[1:] == codes[:-1]) & (line[1:] == line[:-1])))
    distinct = np.bincount(np.unique(line * (len(words) + 1) + codes) // (len(words) + 1), minlength=len(lines))
    repeated = in_repeated_window(codes, at[offsets], len(words))
    coded = lines.dictionary_encode()
    key = doc * (len(coded.dictionary) + 1) + coded.indices.to_numpy(zero_copy_only=False)
    seen = np.ones(len(lines), bool)
    seen[np.unique(key, return_index=True)[1]] = False
    sentence = np.isin(raw[ends[1:] - 1], list(b".!?"))
    count = np.diff(offsets)[doc]
    return offsets, chars, np.stack([
        np.log(chars), np.log(n), row_sums(size, at) / n, symbols, capitals, digits, marks, row_sums(again.astype(np.int64), at) / n, 1 - distinct / n,
        row_sums(repeated.astype(np.int64), at) / n, row_sums((size <= 3).astype(np.int64), at) / n, seen, sentence, np.log(count)], axis=1)


def neighbour_bins(features: np.ndarray, offsets: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin of each feature of a line, of the line before, and of the line after (0: there is none)."""
    own = np.stack([1 + np.searchsorted(e, features[:, i], side="right") for i, e in enumerate(edges)], axis=1) if len(features) else np.zeros((0, len(edges)), np.int64)
    row = row_numbers(offsets)
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = (row[1:] == row[:-1])[:, None]
    before[1:] = np.where(same, own[:-1], 0)
    after[:-1] = np.where(same, own[1:], 0)
    return np.concatenate([own, before, after], axis=1)


def marginals(score: np.ndarray, offsets: np.ndarray, first: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward for all texts at once.

    ``score`` is each line's weight for "good" over "bad", ``first`` the two states' start
    weights and ``step`` the weights from state to state. Returns the chance of "good" of
    each line, the expected number of each step between states, and each text's log of the
    sum over all labellings.
    """
    n = np.diff(offsets)
    order = np.argsort(-n, kind="stable")
    start, length = offsets[:-1][order], n[order]
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(1, longest + 1), side="right")  # texts with a line at each step
    forward, backward = np.zeros((len(score), 2)), np.zeros((len(score), 2))
    lines = np.stack([np.zeros(len(score)), score], axis=1)
    for t in range(longest):
        at = start[:active[t]] + t
        if t:
            last = forward[at - 1]
            forward[at] = lines[at] + np.logaddexp(last[:, :1] + step[0], last[:, 1:] + step[1])
        else:
            forward[at] = lines[at] + first
    for t in range(longest - 2, -1, -1):
        at = start[:active[t + 1]] + t
        following = lines[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(step[:, 0] + following[:, :1], step[:, 1] + following[:, 1:])
    both = forward + backward
    total = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - total)
    row = row_numbers(offsets)
    at = np.flatnonzero(row[1:] == row[:-1])
    pair = forward[at][:, :, None] + step + (lines[at + 1] + backward[at + 1])[:, None, :] - total[at][:, None, None]
    ends = offsets[1:][n > 0] - 1
    return good, np.exp(pair).sum(axis=0), np.logaddexp(forward[ends, 0], forward[ends, 1])


@dataclass
class Chain:
    edges: list[np.ndarray]
    weight: np.ndarray   # of each bin of each feature of a line and its neighbours
    first: np.ndarray
    step: np.ndarray
    curve: np.ndarray    # weight of the aggregate's log odds, and a constant

    def lines(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line offsets, characters, chance of "good") of every line with a word."""
        offsets, chars, features = line_features(texts)
        bins = neighbour_bins(features, offsets, self.edges)
        return offsets, chars, marginals(self.weight[np.arange(bins.shape[1]), bins].sum(axis=1), offsets, self.first, self.step)[0]

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Log odds of the length-weighted share of "good"; 0 without lines."""
        offsets, chars, good = self.lines(texts)
        weight = row_sums(chars, offsets)
        share = np.where(weight > 0, row_sums(good * chars, offsets) / np.maximum(weight, 1e-9), 0.5)
        share = np.clip(share, 1e-4, 1 - 1e-4)
        return np.log(share) - np.log1p(-share)

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(texts) * self.curve[0] + self.curve[1], -30, 30)))


def train_chain(offsets: np.ndarray, features: np.ndarray, label: np.ndarray) -> Chain:
    """Fit the chain by full-batch Adam on the log-likelihood; ``label`` is each text's."""
    edges = [np.unique(np.quantile(features[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(features.shape[1])]
    bins = neighbour_bins(features, offsets, edges)
    row = row_numbers(offsets)
    y = label[row].astype(float)
    n_bins = BINS + 2
    flat = bins + np.arange(bins.shape[1]) * n_bins
    balance = np.where(y > 0, len(y) / (2 * max(y.sum(), 1)), len(y) / (2 * max((1 - y).sum(), 1)))  # both labels weigh alike
    same = np.flatnonzero(row[1:] == row[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[row[same]], label[row[same]]), 1)
    begins = np.bincount(label[np.diff(offsets) > 0], minlength=2).astype(float)
    size = bins.shape[1] * n_bins
    theta, m, v = np.zeros(size + 6), np.zeros(size + 6), np.zeros(size + 6)
    for t in range(1, ROUNDS + 1):
        weight, first, step = theta[:size], theta[size:size + 2], theta[size + 2:].reshape(2, 2)
        good, steps, _ = marginals(weight[flat].sum(axis=1), offsets, first, step)
        missing = (y - good) * balance
        gradient = np.concatenate([
            np.bincount(flat.ravel(), np.repeat(missing, flat.shape[1]), minlength=size),
            begins - _starts(good, offsets), (seen - steps).ravel()]) / len(y) - RIDGE * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient ** 2
        theta = theta + 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return Chain(edges, theta[:size].reshape(-1, n_bins), theta[size:size + 2], theta[size + 2:].reshape(2, 2), np.array([1.0, 0.0]))


def _starts(good: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    at = offsets[:-1][np.diff(offsets) > 0]
    return np.array([(1 - good[at]).sum(), good[at].sum()])


def fit(docs: DataFrame, marks: DataFrame, label: str = "quality", fold: int = 3, held: int = 1, sample: int = SAMPLE) -> Chain:
    """Train on the bounded sample; only its line features come to the driver."""
    from orderlens.sources.files import materialize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                offsets, _, features = line_features(texts_of(part))
                rows = [features[a:b].astype(np.float32).tobytes() if b - a <= FIT_LINES else None for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), part.column("label")], names=["features", "label"])
    rows = materialize(labelled(docs, marks, label, fold, held, sample), "quality-sample")
    lines = rows.where("counts").select("text", "label").mapInArrow(run, "features binary, label int").where("features is not null").toArrow().to_pandas()
    share = float(rows.agg(F.coalesce(F.avg("label"), F.lit(0.5))).first()[0])
    constant = np.log(share + 1e-6) - np.log(1 - share + 1e-6)
    if lines["label"].nunique() < 2:
        width = len(FEATURES)
        return Chain([np.zeros(0)] * width, np.zeros((3 * width, BINS + 2)), np.zeros(2), np.zeros((2, 2)), np.array([0.0, constant]))
    matrices = [np.frombuffer(x, np.float32).reshape(-1, len(FEATURES)) for x in lines["features"]]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in matrices])))
    chain = train_chain(offsets, np.concatenate(matrices).astype(float), lines["label"].to_numpy())
    shared = rows.sparkSession.sparkContext.broadcast(chain)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([pa.array(shared.value.evidence(texts_of(part))), part.column("label")], names=["evidence", "label"])
    curve = rows.where("not counts").select("text", "label").mapInArrow(judge, "evidence double, label int").toArrow().to_pandas()
    if curve["label"].nunique() == 2:
        x = np.stack([curve["evidence"].to_numpy(), np.ones(len(curve))], axis=1)
        chain.curve = logistic(x, curve["label"].to_numpy(float))
    return chain


def score_documents(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, score of every document's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield append_columns(part.select(["doc_id"]), score=shared.value.score(texts_of(part)))
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, rows.select("doc_id").schema.add("score", "double"))


def label_lines(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, line (among those with a word), chars, good (marginal chance) of every line."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                offsets, chars, good = shared.value.lines(texts_of(part))
                row = row_numbers(offsets)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(row)), pa.array((np.arange(len(row)) - offsets[row]).astype(np.int32)),
                    pa.array(chars.astype(np.int32)), pa.array(good)], names=["doc_id", "line", "chars", "good"])
    rows = docs.select("doc_id", "text")
    schema = rows.select("doc_id").schema.add("line", "integer").add("chars", "integer").add("good", "double")
    return rows.mapInArrow(run, schema)


def op2_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlens.llm.common import documents, labels
    docs = documents(spark, sf_dir)
    scored = score_documents(docs, fit(docs, labels(spark, sf_dir)))
    return scored.select("doc_id", (id_crc32(F.col("doc_id")) % 3 == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
