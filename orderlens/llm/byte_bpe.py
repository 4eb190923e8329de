"""Byte-level BPE by a hierarchical-bitmap rank queue, encoding and decoding.

A text's pre-tokens (the matches of the tokenizer's pattern) are merged separately, always
the pair of lowest rank first, the leftmost of equals. ``merge`` does that for many
pre-tokens at once, laid end to end in one linked list:

* one bucket for each merge rank holds the list positions whose pair has that rank;
* a bitmap of three levels over the ranks tells the first bucket that is not empty by
  find-first-set;
* a position whose pair has changed since it was put into a bucket is stale and skipped.

A bucket is emptied at once, as whole columns, where that is the same as leftmost first: a
merge of that rank can then make no pair of a lower rank (a table tells for each rank), or
only one pair for each pre-token is taken. Else its positions are taken one by one from a
heap. Either way the work grows with a pre-token's length, not with its square.

Documents are read in slices of bounded text size, nothing is shuffled. Texts are cut before
each space that follows a visible character, where the pattern always cuts too; the distinct
parts of a slice are cut by the pattern, and the distinct pre-tokens merged, once. Workers
remember the ids of a bounded number of short parts.

Defined cases: null text is empty and has no ids; null ids are kept; repeated rows are
encoded like others; there are no special tokens; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderlens.llm.common import ragged, slices, text_bytes, texts_of

RANKS = "byte_bpe_multi_50k.tiktoken"
BLOCK_BYTES = 8 << 20
#: Parts whose ids a worker remembers, and their longest length.
REMEMBERED, REMEMBERED_BYTES = 150_000, 40
#: Pairs of one rank in one pre-token that are taken in rounds; more are taken from a heap.
ROUNDS = 8
_LOADED: dict[str, "Ranks"] = {}


@dataclass
class Ranks:
    """A vocabulary: pieces by rank, which pairs merge to which rank, which ranks go leftmost first."""

    pieces: list[bytes]
    by_piece: dict[bytes, int]
    of_byte: np.ndarray
    pairs: np.ndarray      # left * (size + 1) + right, ascending
    merged: np.ndarray     # their rank
    careful: np.ndarray    # a merge of this rank may make a pair of a lower rank
    pattern: object
    remembered: dict[bytes, bytes] = field(default_factory=dict)

    @classmethod
    def load(cls, name: str) -> "Ranks":
        if name not in _LOADED:
            import public_tokenizers
            import regex
            with open(public_tokenizers.path(name), "rb") as f:
                by_piece = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            _LOADED[name] = cls.build(by_piece, regex.compile(public_tokenizers.PATTERN))
        return _LOADED[name]

    @classmethod
    def build(cls, by_piece: dict[bytes, int], pattern=None) -> "Ranks":
        size = max(by_piece.values()) + 1
        pieces = [b""] * size
        pairs, merged, careful = [], [], np.zeros(size, bool)
        for piece, rank in by_piece.items():
            pieces[rank] = piece
            for k in range(1, len(piece)):
                left, right = by_piece.get(piece[:k]), by_piece.get(piece[k:])
                if left is not None and right is not None:
                    pairs.append(left * (size + 1) + right)
                    merged.append(rank)
                    for part in (left, right):
                        careful[part] |= part > rank
        order = np.argsort(np.array(pairs, np.int64), kind="stable")
        of_byte = np.array([by_piece[bytes([b])] for b in range(256)], np.int64)
        return cls(pieces, by_piece, of_byte, np.array(pairs, np.int64)[order], np.array(merged, np.int64)[order], careful, pattern)

    @property
    def size(self) -> int:
        return len(self.pieces)

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, ``size`` where there is none."""
        if not len(self.pairs):
            return np.full(len(left), self.size)
        key = left * (self.size + 1) + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.merged[at], self.size)


class RankQueue:
    """Buckets of positions by rank, under a bitmap of three levels of 64-bit words."""

    def __init__(self, n_ranks: int):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.low = [0] * ((n_ranks >> 6) + 1)
        self.mid = [0] * ((n_ranks >> 12) + 1)
        self.top = 0

    def push(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [positions]
            self.low[rank >> 6] |= 1 << (rank & 63)
            self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
            self.top |= 1 << (rank >> 12)
        else:
            bucket.append(positions)

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Each position into the bucket of its rank."""
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        ends = np.concatenate((np.flatnonzero(np.diff(ranks)) + 1, [len(ranks)]))
        start = 0
        for end in ends.tolist():
            self.push(int(ranks[start]), positions[start:end])
            start = end

    def first(self) -> int:
        """The lowest rank with a bucket, -1 if there is none."""
        if not self.top:
            return -1
        top = (self.top & -self.top).bit_length() - 1
        word = self.mid[top]
        mid = top << 6 | (word & -word).bit_length() - 1
        word = self.low[mid]
        return mid << 6 | (word & -word).bit_length() - 1

    def take(self, rank: int) -> np.ndarray:
        """All positions of a rank; its bucket is gone."""
        bucket = self.buckets.pop(rank)
        self.low[rank >> 6] &= ~(1 << (rank & 63))
        if not self.low[rank >> 6]:
            self.mid[rank >> 12] &= ~(1 << (rank >> 6 & 63))
            if not self.mid[rank >> 12]:
                self.top &= ~(1 << (rank >> 12))
        return bucket[0] if len(bucket) == 1 else np.concatenate(bucket)


class _List:
    """Pre-tokens end to end as a linked list of ids; the place after the last one stands for none."""

    def __init__(self, ranks: Ranks, raw: np.ndarray, starts: np.ndarray):
        n = len(raw)
        self.ranks, self.none = ranks, n
        self.id = np.append(ranks.of_byte[raw], ranks.size)
        self.next, self.before = np.arange(1, n + 2), np.arange(-1, n)
        self.next[np.append(starts[1:], n) - 1] = n
        self.before[starts] = n
        self.next[n] = self.before[n] = n
        self.word = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
        self.rank = np.append(ranks.of_pairs(self.id[:-1], self.id[self.next[:-1]]), ranks.size)
        self.alive = np.ones(n, bool)
        self.queue = RankQueue(ranks.size)
        some = np.flatnonzero(self.rank < ranks.size)
        self.queue.push_all(self.rank[some], some)

    def merge(self, rank: int, at: np.ndarray) -> None:
        """Join the pairs at ``at``, which do not overlap, and queue the pairs that they make."""
        gone = self.next[at]
        after = self.next[gone]
        self.id[at], self.next[at], self.before[after] = rank, after, at
        self.before[self.none] = self.none
        self.alive[gone], self.rank[gone] = False, self.ranks.size
        left = self.before[at]
        left = left[left != self.none]
        changed = np.unique(np.concatenate((at, left))) if len(left) else at
        made = self.ranks.of_pairs(self.id[changed], self.id[self.next[changed]])
        self.rank[changed] = made
        some = made < self.ranks.size
        self.queue.push_all(made[some], changed[some])

    def run(self) -> None:
        """Merge until no pair has a rank."""
        heaps: dict[int, list[int]] = {}
        while (rank := self.queue.first()) >= 0:
            at = np.unique(self.queue.take(rank))
            at = at[self.rank[at] == rank]  # the others are stale
            if rank in heaps:
                for p in at.tolist():
                    heappush(heaps[rank], p)
                self._one_by_one(rank, heaps)
            elif not self.ranks.careful[rank]:
                self.merge(rank, self._apart(at))
            elif len(at):
                word = self.word[at]
                leftmost = np.append(True, word[1:] != word[:-1])
                if not leftmost.all() and np.diff(np.append(np.flatnonzero(leftmost), len(at))).max() > ROUNDS:
                    heaps[rank] = at.tolist()
                    heapify(heaps[rank])
                    self._one_by_one(rank, heaps)
                else:
                    self.merge(rank, at[leftmost])
                    if not leftmost.all():
                        self.queue.push(rank, at[~leftmost])

    def _apart(self, at: np.ndarray) -> np.ndarray:
        """Of pairs that overlap (equal ids in a row) the first, third, ..."""
        if len(at) < 2:
            return at
        chained = self.next[at[:-1]] == at[1:]
        if not chained.any():
            return at
        index = np.arange(len(at))
        start = np.maximum.accumulate(np.where(np.append(True, ~chained), index, 0))
        return at[(index - start) % 2 == 0]

    def _one_by_one(self, rank: int, heaps: dict[int, list[int]]) -> None:
        """Merge a rank's pairs leftmost first, until a lower rank comes up."""
        heap = heaps[rank]
        while heap:
            p = heappop(heap)
            if self.rank[p] == rank:
                self.merge(rank, np.array([p]))
                lowest = self.queue.first()
                if 0 <= lowest < rank:
                    if heap:
                        self.queue.push(rank, np.zeros(0, np.int64))  # come back for the rest
                    else:
                        del heaps[rank]
                    return
        del heaps[rank]


def merge(ranks: Ranks, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, ids of each word). A word that is a piece is its id."""
    whole = np.array([ranks.by_piece.get(w, -1) for w in words], np.int64)
    rest = [w for w, i in zip(words, whole.tolist()) if i < 0]
    size = np.array([len(w) for w in rest], np.int64)
    if not size.sum():  # none, or empty words only
        return whole[whole >= 0], (whole >= 0).astype(np.int64)
    filled = size > 0
    starts = (np.cumsum(size) - size)[filled]
    chain = _List(ranks, np.frombuffer(b"".join(rest), np.uint8), starts)
    chain.run()
    alive = np.flatnonzero(chain.alive)
    per_rest = np.zeros(len(rest), np.int64)
    per_rest[filled] = np.bincount(chain.word[alive], minlength=len(starts))
    count = np.ones(len(words), np.int64)
    count[whole < 0] = per_rest
    ids = np.empty(int(count.sum()), np.int64)
    own = np.repeat(whole, count)
    ids[own >= 0] = own[own >= 0]
    ids[own < 0] = chain.id[alive]
    return ids, count


def _parts(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(texts cut before each space after a visible character, parts of each text)."""
    raw, ends = text_bytes(texts)
    visible = (raw > 0x20) & (raw < 0x7F)
    visible[1:] |= (raw[:-1] >= 0xC3) & (raw[:-1] <= 0xDF)  # letters and signs of two bytes, none of them a space
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = (raw[1:] == 0x20) & visible[:-1]
    cut[ends] = True
    places = np.flatnonzero(cut)
    number = np.searchsorted(places, ends)
    if len(places) < 2:
        return pa.array([], pa.binary()).dictionary_encode(), np.diff(number)
    cells = pa.BinaryArray.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(raw)])
    return cells.dictionary_encode(), np.diff(number)


def _part_ids(ranks: Ranks, parts: list[bytes]) -> list[bytes]:
    """Ids of each part as packed 32-bit numbers."""
    found = [ranks.remembered.get(p) for p in parts]
    missing = [i for i, x in enumerate(found) if x is None]
    words = [ranks.pattern.findall(parts[i].decode()) for i in missing]
    coded = pa.array([w for x in words for w in x], pa.string()).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ids, count = merge(ranks, [w.encode() for w in coded.dictionary.to_pylist()])
    store = ragged(ids.astype("<u4"), (np.cumsum(count) - count)[code], count[code])
    each = np.concatenate(([0], np.cumsum(count[code])))[np.concatenate(([0], np.cumsum([len(x) for x in words], dtype=np.int64)))]
    blob, place = store.tobytes(), (4 * each).tolist()
    for k, i in enumerate(missing):
        found[i] = blob[place[k]:place[k + 1]]
        if len(parts[i]) <= REMEMBERED_BYTES and len(ranks.remembered) < REMEMBERED:
            ranks.remembered[parts[i]] = found[i]
    return found


def encoded_texts(texts: pa.Array, name: str = RANKS) -> Iterator[bytes]:
    """The ids of each text as packed little-endian 32-bit numbers."""
    cells, n_parts = _parts(texts)
    blobs = _part_ids(Ranks.load(name), cells.dictionary.to_pylist())
    code, start = cells.indices.to_numpy(zero_copy_only=False), 0
    for n in n_parts.tolist():
        yield b"".join([blobs[c] for c in code[start:start + n].tolist()])
        start += n


def decoded_ids(ids: bytes, name: str = RANKS) -> bytes:
    """The bytes that packed ids stand for."""
    pieces = Ranks.load(name).pieces
    return b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _per_text(docs: DataFrame, columns: list[T.StructField], values, name: str) -> DataFrame:
    """doc_id and the ``columns`` that ``values(packed ids)`` gives for each document."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=BLOCK_BYTES):
                rows = zip(*map(values, encoded_texts(texts_of(part), name)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(list(x)) for x in rows)], names=schema.names)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encode(docs: DataFrame, name: str = RANKS) -> DataFrame:
    """doc_id, ids of every document."""
    return _per_text(docs, [T.StructField("ids", T.ArrayType(T.IntegerType()))], lambda ids: (np.frombuffer(ids, "<i4"),), name)


def decode(encoded: DataFrame, name: str = RANKS) -> DataFrame:
    """``encoded`` (with ids, an array of int) and the bytes they stand for as ``decoded``; null ids give null."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [None if x is None else decoded_ids(np.array(x, "<u4").tobytes(), name) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=schema.names)
    return encoded.mapInArrow(run, schema)


def encode_and_decode(docs: DataFrame, name: str = RANKS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    def values(ids: bytes):
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded_ids(ids, name)).hexdigest()
    return _per_text(docs, [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                            T.StructField("decoded_sha256", T.StringType())], values, name)


def op12_rank_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlens.llm.common import documents
    return encode_and_decode(documents(spark, sf_dir))
