"""Trie of conversation prefixes, in node tables under minimal perfect hashes.

Conversations are rebuilt turn by turn and every prefix becomes a 128-bit digest: the xor of
hashes of (place, MD5 of the turn), so it runs along a conversation in one window. Texts are
read once, for their MD5 and length, and never shuffled.

Sums over subtrees are taken in shards that hold whole pieces of the trie:

1. A prefix with up to ``LIMIT`` members is of tier 0, one with up to LIMIT^2 of tier 1, and
   so on; tiers never rise on the way down. Nodes of one tier that hang together are a
   component, which has at most ``LIMIT`` nodes of each depth, however many conversations
   share a first turn. Components are dealt to shards by the digest of their top node, about
   ``SHARD_NODES`` nodes to each.
2. A shard enumerates its distinct digests and gives each a slot by a minimal perfect hash;
   the digest stored in the slot verifies every look-up. Counts are scattered into flat
   arrays by slot, and sums run from parent slot to parent slot, deepest nodes first.
3. The top nodes of a tier's components go on as rows to the component of their parent, one
   tier up. There are as many rounds as tiers, the logarithm of the number of conversations
   to the base ``LIMIT``.

The digest of the members that end in a node is taken over chunks: ids are put in order by
range partitions, joined to chunks of text there, and a node's chunks hashed one after the
other. That last step is sequential by nature; it streams, whatever a node's size.

Defined cases: rows without conv_id belong to no conversation and are left out; null role
or text is empty; null turns come first, and turns of equal number are put in the order of
their MD5; repeated rows are turns of their own; of a negative conv_id the remainder is
negative as in SQL; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.common import id_crc32, mix64
from orderlens.sources.files import materialize

LIMIT = 4096
SHARD_NODES = 50_000
#: Large prefixes (24 bytes each) that are broadcast at most.
BROADCAST_ROWS = 1_000_000
#: Ids that are joined to one chunk of text.
CHUNK = 4096
#: Places of a level of the hash for each key that is left.
SPARSE = 2
EMPTY = hashlib.sha256(b"").hexdigest()
U64 = np.uint64
RESULT = ("done boolean, p1 long, p2 long, q1 long, q2 long, tier int, r1 long, r2 long, conv_id long, depth long, parent_conv_id long, "
          "n_convs long, n_children long, n_leaves long, saved_tokens long")


# ---------------------------------------------------------------- rebuilt conversations

def rebuilt(conversations: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """base, conv_id, depth, turn (MD5; null at depth 0), chars of every rebuilt conversation, from depth 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), F.col("turn").alias("place"), turn.alias("turn"), F.length(text).cast("long").alias("chars"))
    # all that meets below lies in the same 100 ids: one shuffle
    rows = rows.withColumn("base", F.col("conv_id") - F.col("conv_id") % block).repartition("base")
    numbered = rows.withColumn("place", F.row_number().over(
        Window.partitionBy("base", "conv_id").orderBy(F.col("place").asc_nulls_first(), "turn")))
    shared = (id_crc32(F.col("conv_id")) % most).cast("int")
    heads = numbered.where((F.col("conv_id") == F.col("base")) & (F.col("place") < most)).select("base", "place", "turn", "chars")
    convs = numbered.select("base", "conv_id").distinct().withColumn("shared", shared)
    first = heads.join(convs, "base").where(F.col("place") <= F.col("shared")).select("base", "conv_id", F.lit(1).alias("part"), "place", "turn", "chars")
    own = numbered.where(F.col("place") > shared).select("base", "conv_id", F.lit(2).alias("part"), "place", "turn", "chars")
    root = convs.select("base", "conv_id", F.lit(0).alias("part"), F.lit(0).alias("place"), F.lit(None).cast("binary").alias("turn"),
                        F.lit(0).cast("long").alias("chars"))
    in_order = Window.partitionBy("base", "conv_id").orderBy("part", "place")
    return (root.unionByName(first).unionByName(own).withColumn("depth", F.row_number().over(in_order).cast("long") - 1)
            .select("base", "conv_id", "depth", "turn", "chars"))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, p1, p2 (digest), q1, q2 (the parent's), chars, ends of every prefix."""
    along = Window.partitionBy("base", "conv_id").orderBy("depth")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    known = F.col("turn").isNotNull()
    rows = turns.select("*", *[F.when(known, F.xxhash64(F.lit(k), "depth", "turn")).otherwise(F.lit(0).cast("long")).alias(f"x{k}") for k in (1, 2)])
    rows = rows.withColumns({f"p{k}": F.bit_xor(f"x{k}").over(so_far) for k in (1, 2)})
    return rows.select("conv_id", "depth", "p1", "p2", F.lag("p1").over(along).alias("q1"), F.lag("p2").over(along).alias("q2"), "chars",
                       F.lead("depth").over(along).isNull().alias("ends"))


# ---------------------------------------------------------------- components

def nodes(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """A row for each distinct prefix, with its tier, the top (r1, r2) of its component, and
    for a top node the tier and top of its parent's component (up_tier, u1, u2)."""
    large = rows.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > limit)
    large = materialize(large, "trie-large")
    if large.count() <= BROADCAST_ROWS:  # else both sides shuffle, and a prefix of many members is split as skewed
        large = F.broadcast(large)
    tier = F.coalesce(F.floor(F.log("members") / F.log(F.lit(float(limit)))).cast("int"), F.lit(0))
    along = Window.partitionBy("conv_id").orderBy("depth")
    tiered = rows.join(large, ["p1", "p2"], "left").withColumn("tier", tier).withColumn("up_tier", F.lag("tier").over(along))
    top = F.col("tier") < F.col("up_tier")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    placed = tiered.withColumns({f"r{k}": F.coalesce(F.last(F.when(top, F.col(f"p{k}")), ignorenulls=True).over(so_far), F.lit(0).cast("long"))
                                 for k in (1, 2)})
    placed = placed.withColumns({f"u{k}": F.lag(f"r{k}").over(along) for k in (1, 2)})
    # the root has no parent; 0 stands for it, as nulls would make these columns doubles in pandas
    placed = placed.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("q1", "q2", "up_tier", "u1", "u2")})
    keys = ["p1", "p2", "q1", "q2", "depth", "chars", "tier", "r1", "r2", "up_tier", "u1", "u2"]
    return placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys: levels of bit arrays, in which only the
    keys without a rival stay, the others try the next level. A slot is a key's rank among the
    set bits; the key kept in the slot tells keys that are not in the table."""

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, int]] = []   # (places, slot of each place or -1, seed)
        self.high, self.low = np.zeros(len(high), np.int64), np.zeros(len(low), np.int64)
        left, used = np.arange(len(high)), 0
        while len(left):
            places, seed = SPARSE * len(left) + 1, len(self.levels)
            if seed > 200:
                raise ValueError("two different prefixes have one digest")
            at = self._place(high[left], low[left], seed, places)
            alone = np.bincount(at, minlength=places)[at] == 1
            slot = np.full(places, -1, np.int64)
            slot[np.sort(at[alone])] = used + np.arange(int(alone.sum()))
            self.high[slot[at[alone]]], self.low[slot[at[alone]]] = high[left[alone]], low[left[alone]]
            self.levels.append((places, slot, seed))
            used += int(alone.sum())
            left = left[~alone]

    @staticmethod
    def _place(high, low, seed: int, places: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = mix64(high.view(U64) + U64(seed) * U64(0xD6E8FEB86659FD93))
            return (mix64(x ^ low.view(U64)) % U64(places)).astype(np.int64)

    def __call__(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for keys that are not in the table."""
        out, left = np.full(len(high), -1, np.int64), np.arange(len(high))
        for places, slot, seed in self.levels:
            found = slot[self._place(high[left], low[left], seed, places)]
            out[left[found >= 0]] = found[found >= 0]
            left = left[found < 0]
        hit = np.flatnonzero(out >= 0)
        wrong = hit[(self.high[out[hit]] != high[hit]) | (self.low[out[hit]] != low[hit])]
        out[wrong] = -1
        return out


def sum_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of RESULT for a shard: its own nodes, and the finished top nodes that came from the
    tiers below (``child``). Top nodes of this shard's components are not done yet."""
    own, child = rows[~rows["child"]], rows[rows["child"]]
    key = own[["p1", "p2", "q1", "q2", "depth", "chars"]].drop_duplicates()
    high, low = key["p1"].to_numpy(np.int64), key["p2"].to_numpy(np.int64)
    table = PerfectHash(high, low)
    size = len(key)
    count, first = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    depth, chars, parent = np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, -1, np.int64)
    slot = table(own["p1"].to_numpy(np.int64), own["p2"].to_numpy(np.int64))
    np.add.at(count, slot, own["n"].to_numpy(np.int64))
    np.minimum.at(first, slot, own["conv_id"].to_numpy(np.int64))
    depth[slot], chars[slot] = own["depth"].to_numpy(np.int64), own["chars"].to_numpy(np.int64)
    below = own["depth"].to_numpy(np.int64) > 0
    parent[slot[below]] = table(own["q1"].to_numpy(np.int64)[below], own["q2"].to_numpy(np.int64)[below])
    inner = np.flatnonzero(parent >= 0)
    children, leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64), (count - 1) * chars
    np.add.at(children, parent[inner], 1)
    under = table(child["q1"].to_numpy(np.int64), child["q2"].to_numpy(np.int64))
    if (under < 0).any():
        raise ValueError("a component's parent is not in the shard it was sent to")
    np.add.at(children, under, 1)
    np.add.at(leaves, under, child["n_leaves"].to_numpy(np.int64))
    np.add.at(saved, under, child["saved_tokens"].to_numpy(np.int64))
    leaves[children == 0] = 1
    order = inner[np.argsort(-depth[inner], kind="stable")]
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    once = own.drop_duplicates(["p1", "p2"])
    at = table(once["p1"].to_numpy(np.int64), once["p2"].to_numpy(np.int64))
    up = parent[at]
    mine = pd.DataFrame({
        "done": (up >= 0) | (depth[at] == 0), "p1": once["p1"], "p2": once["p2"], "q1": once["q1"], "q2": once["q2"], "tier": once["up_tier"],
        "r1": once["u1"], "r2": once["u2"], "conv_id": first[at], "depth": depth[at], "parent_conv_id": np.where(up >= 0, first[up], 0),
        "n_convs": count[at], "n_children": children[at], "n_leaves": leaves[at], "saved_tokens": saved[at]})
    theirs = child.assign(done=True, parent_conv_id=first[under], n_convs=child["n"])
    return pd.concat([mine, theirs[mine.columns]])


def subtree_sums(found: DataFrame) -> DataFrame:
    """RESULT rows of all nodes, tier by tier from the bottom."""
    spark = found.sparkSession
    sizes = dict(found.groupBy("tier").count().collect())  # a row for each tier
    zero = F.lit(0).cast("long")
    own = found.select(F.lit(False).alias("child"), "tier", "r1", "r2", "p1", "p2", "q1", "q2", "depth", "chars", "n", "conv_id", "up_tier", "u1", "u2",
                       *[zero.alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
    waiting, finished = None, []
    for tier in sorted(sizes):
        rows, n_rows = own.where(F.col("tier") == tier), sizes[tier]
        if waiting is not None:
            rows = rows.unionByName(waiting.where(F.col("tier") == tier))
            n_rows += waiting.where(F.col("tier") == tier).count()
        n_shards = max(1, -(-n_rows // SHARD_NODES))
        shard = F.pmod(F.xxhash64("r1", "r2"), F.lit(n_shards))
        out = materialize(rows.groupBy(shard.alias("shard")).applyInPandas(sum_shard, RESULT), "trie-sums")
        finished.append(out.where("done"))
        up = out.where("not done").select(
            F.lit(True).alias("child"), "tier", "r1", "r2", "p1", "p2", "q1", "q2", "depth", zero.alias("chars"),
            F.col("n_convs").alias("n"), "conv_id", F.lit(0).alias("up_tier"), zero.alias("u1"), zero.alias("u2"),
            "n_children", "n_leaves", "saved_tokens")
        waiting = up if waiting is None else waiting.where(F.col("tier") > tier).unionByName(up)
    if not finished:
        return spark.createDataFrame([], RESULT)
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out


# ---------------------------------------------------------------- members that end in a node

def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """(key, start, stop) of the runs of rows with equal (p1, p2)."""
    if batch.num_rows:
        p1, p2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("p1", "p2"))
        edges = [0, *(np.flatnonzero((np.diff(p1) != 0) | (np.diff(p2) != 0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            yield (int(p1[a]), int(p2[a])), a, b


def ends_sha256(rows: DataFrame) -> DataFrame:
    """p1, p2, ends_sha256 of the nodes in which members end."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for (p1, p2), a, b in _runs(batch):
                ids = batch.column("conv_id").slice(a, b - a).to_pylist()
                out += [(p1, p2, ids[k], ",".join(map(str, ids[k:k + CHUNK])).encode()) for k in range(0, len(ids), CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                                              pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.binary())],
                                             names=["p1", "p2", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, running = None, None
        for batch in batches:
            out = []
            texts = batch.column("ids")
            for key, a, b in _runs(batch):
                if key != at:
                    if at is not None:
                        out.append((*at, running.hexdigest()))
                    at, running = key, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(b",".join(texts.slice(a, b - a).to_pylist()))
            yield _digest_rows(out)
        if at is not None:
            yield _digest_rows([(*at, running.hexdigest())])
    ends = rows.where("ends").select("p1", "p2", "conv_id")
    in_order = ends.repartitionByRange("p1", "p2", "conv_id").sortWithinPartitions("p1", "p2", "conv_id")
    cut = in_order.mapInArrow(chunks, "p1 long, p2 long, first long, ids binary")
    return cut.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first").mapInArrow(digests, "p1 long, p2 long, ends_sha256 string")


def _digest_rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                                       pa.array([x[2] for x in out], pa.string())], names=["p1", "p2", "ends_sha256"])


# ---------------------------------------------------------------- the trie

def prefix_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = materialize(prefixes(rebuilt(conversations)), "trie-prefixes")
    sums = subtree_sums(materialize(nodes(rows, limit), "trie-nodes"))
    return (sums.join(ends_sha256(rows), ["p1", "p2"], "left")
            .select("conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
