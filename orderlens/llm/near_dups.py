"""MinHash near-duplicates with SetSketch registers.

Documents of the same words are one class first; classes are compared.

1. A class's set of word shingles is sketched into ``REGISTERS`` registers: the least of
   the hashes of all shingles, on an exponential scale of base ``BASE``, truncated to a
   byte. Registers merge by maximum, and two sets agree in a register about as often as
   they are similar.
2. Registers are banded; classes that agree in a band share a bucket. In each bucket every
   member is paired with one hub, not with every other member.
3. A pair's similarity is estimated by maximum likelihood from the numbers of greater,
   smaller and equal registers and the known set sizes. Pairs that may reach the threshold
   are verified on their full sets.
4. Verified links make components. Members of a bucket that still holds several are paired
   with its most linked member; then it is searched in full: members outside its largest
   component against all members, in square tiles of blocks of bounded size, estimates first,
   verification after. Members of one component need no more links, so large groups of copies
   cost no more than their members.

Defined cases: null and empty texts have empty sets and are linked with nothing; null ids
take part in no group (component null, kept); repeated rows are copies like others; ids
that occur with several texts join those texts' groups only through the id that is
reported; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import mix64, ragged, slices, split_words, texts_of, word_hashes
from orderlens.llm.components import connected_components
from orderlens.sources.files import materialize

REGISTERS = 256
BAND_ROWS = 6
BASE = 1.15
RATE = 1 / 16
#: How far below the threshold an estimate may lie before its pair is left out: 4.7 standard errors.
ESTIMATE_SLACK = 0.12
TILE = 512
#: Ids that are broadcast at most (16 bytes each); above, the join shuffles.
BROADCAST_ROWS = 1_000_000
U32, U64 = np.uint32, np.uint64
_RNG = np.random.default_rng(20240229)
_MULTIPLY = _RNG.integers(0, 2 ** 32, REGISTERS, dtype=U32) | U32(1)
_ADD = _RNG.integers(0, 2 ** 32, REGISTERS, dtype=U32)


def normal_text(texts: pa.Array) -> pa.Array:
    """A-Z in lower case, words one space apart."""
    return pc.ascii_trim_whitespace(pc.binary_join(pc.ascii_split_whitespace(pc.ascii_lower(texts)), " "))


def shingle_sets(normal: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``width`` make one shingle."""
    offsets, codes, words = split_words(normal)
    token = word_hashes(words)[codes] if len(codes) else np.zeros(0, U64)
    n = np.maximum(len(token) - width + 1, 0)
    shingle = np.full(n, 0x51ED270B, U64)
    for k in range(width):
        shingle = mix64(shingle * U64(0x9E3779B97F4A7C15) + token[k:n + k])
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(shingle[a:b - width + 1]))
        elif b > a:
            whole = np.full(1, 0x2545F491 + b - a, U64)
            for x in token[a:b]:
                whole = mix64(whole * U64(0x9E3779B97F4A7C15) + x)
            out.append(whole)
        else:
            out.append(np.zeros(0, U64))
    return out


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch of a non-empty set: a byte per register."""
    x = (shingles >> U64(32)).astype(U32)
    least = np.full(REGISTERS, 0xFFFFFFFF, U32)
    for start in range(0, len(x), 512):
        v = x[start:start + 512, None] * _MULTIPLY + _ADD
        v ^= v >> U32(15)
        v *= U32(0x2C1B3C6D)
        np.minimum(least, v.min(axis=0), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2 ** 32)
    return np.clip(np.floor(1 - np.log(RATE * exponential) / np.log(BASE)), 0, 255).astype(np.uint8)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of sketches (rows) with known set sizes."""
    above = (a > b).sum(axis=1).astype(float)
    equal = (a == b).sum(axis=1).astype(float)
    below = a.shape[1] - above - equal
    u = n_a / (n_a + n_b)
    v = 1 - u

    def chance(x):
        return np.maximum(-np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE), 1e-12)

    def likelihood(j):
        p, q = chance(u - v * j), chance(v - u * j)
        return above * np.log(p) + below * np.log(q) + equal * np.log(np.maximum(1 - p - q, 1e-12))
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):
        left, right = high - 0.618034 * (high - low), low + 0.618034 * (high - low)
        worse = likelihood(left) < likelihood(right)
        low, high = np.where(worse, left, low), np.where(worse, high, right)
    return (low + high) / 2


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, h1, h2 (hash of the normal text), n (set size), sketch of every document."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("h1", T.LongType()),
                           T.StructField("h2", T.LongType()), T.StructField("n", T.LongType()), T.StructField("sketch", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                normal = normal_text(texts_of(part))
                h1, h2 = _text_hash(normal)
                sets = shingle_sets(normal, width)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(h1), pa.array(h2), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary())], names=schema.names)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _text_hash(normal: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    digests = b"".join(xxhash.xxh3_128_digest(x.as_buffer()) for x in normal)
    both = np.frombuffer(digests, np.int64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _bands(classes: DataFrame) -> DataFrame:
    """key, band, cid: a row for each band of each class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sketch = _matrix(batch.column("sketch")).astype(U64)
            cid = batch.column("cid")
            for band in range(REGISTERS // BAND_ROWS):
                key = np.full(len(sketch), band + 1, U64)
                for k in range(BAND_ROWS):
                    key = (key << U64(8)) | sketch[:, band * BAND_ROWS + k]  # a band number and six bytes: no collisions
                yield pa.RecordBatch.from_arrays([pa.array(mix64(key).view(np.int64)), pa.array(np.full(len(key), band, np.int32)), cid],
                                                 names=["key", "band", "cid"])
    return classes.select("cid", "sketch").mapInArrow(run, "key long, band int, cid long")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, REGISTERS)


def _plausible(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """The pairs ``(a, b)`` whose estimate reaches ``least``."""
    def side(x: str) -> DataFrame:
        return classes.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = (batch.column(x).to_numpy(zero_copy_only=False).astype(float) for x in ("n_a", "n_b"))
            value = estimate(_matrix(batch.column("sketch_a")), _matrix(batch.column("sketch_b")), n_a, n_b)
            yield batch.select(["a", "b"]).filter(pa.array(value >= least))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def sized_broadcast(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` (written, thin) with a broadcast hint where it has at most ``most`` rows."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """cid, packed normal text of the wanted classes (cid, doc_id, h1, h2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                normal = normal_text(texts_of(part))
                h1, h2 = _text_hash(normal)  # ids that occur with several texts
                same = (h1 == part.column("h1").to_numpy()) & (h2 == part.column("h2").to_numpy())
                packed = [zstandard.compress(x.as_buffer(), 3) for x in normal.filter(pa.array(same))]
                yield pa.RecordBatch.from_arrays([part.column("cid").filter(pa.array(same)), pa.array(packed, pa.binary())], names=["cid", "packed"])
    found = docs.select("doc_id", "text").join(sized_broadcast(wanted), "doc_id").mapInArrow(run, "cid long, packed binary")
    return found.dropDuplicates(["cid"])


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                packed = {}
                for side in ("a", "b"):
                    packed.update(zip(part.column(side).to_pylist(), part.column(f"packed_{side}").to_pylist()))
                texts = pa.array([zstandard.decompress(x).decode() for x in packed.values()], pa.string())
                sets = dict(zip(packed, shingle_sets(texts, width)))
                hit = []
                for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist()):
                    both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    hit.append(100 * both >= percent * (len(sets[a]) + len(sets[b]) - both))
                yield part.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))
    joined = pairs
    for side in ("a", "b"):
        joined = joined.join(texts.select(F.col("cid").alias(side), F.col("packed").alias(f"packed_{side}")), side)
    return joined.mapInArrow(run, "a long, b long")


def _links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Verified links among candidate pairs ``(a, b)``, written."""
    pairs = materialize(_plausible(pairs, classes, percent / 100 - ESTIMATE_SLACK), "near-pairs")
    ids = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
    wanted = materialize(classes.select("cid", "doc_id", "h1", "h2").join(ids, "cid"), "near-wanted")
    return materialize(_verified(pairs, materialize(_texts(docs, wanted), "near-texts"), width, percent), "near-links")


def _with_component(rows: DataFrame, components: DataFrame) -> DataFrame:
    return (rows.join(components.withColumnRenamed("node", "cid"), "cid", "left")
            .withColumn("component", F.coalesce("component", "cid")))


def _other_hubs(members: DataFrame, components: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs of the members of buckets that hold several components with the bucket's most linked
    member, where these are of different components."""
    ends = links.select(F.col("a").alias("cid")).unionByName(links.select(F.col("b").alias("cid")))
    degree = ends.groupBy("cid").agg(F.count(F.lit(1)).alias("degree"))
    known = _with_component(members.select("key", "cid"), components).join(degree, "cid", "left")
    known = materialize(known.withColumn("degree", F.coalesce("degree", F.lit(0))), "near-known")
    hubs = known.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                    F.max(F.struct("degree", "cid", "component")).alias("hub"))
    hubs = hubs.where("low <> high").select("key", F.col("hub.cid").alias("a"), F.col("hub.component").alias("of"))
    return known.join(hubs, "key").where(F.col("component") != F.col("of")).select("a", F.col("cid").alias("b")).distinct()


def _open_members(members: DataFrame, components: DataFrame, classes: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with their sketches and the numbers of
    blocks (by: of all members, bx: of those outside the largest component), written."""
    known = materialize(_with_component(members.select("key", "band", "cid"), components), "near-members")
    size = known.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    bucket = (size.groupBy("key").agg(F.sum("n").alias("n_y"), F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component")).alias("top"))
              .where((F.col("parts") > 1) & (F.col("n_y") > 2))
              .select("key", F.col("top.component").alias("major"), F.ceil(F.col("n_y") / TILE).cast("int").alias("by"),
                      F.ceil((F.col("n_y") - F.col("top.n")) / TILE).cast("int").alias("bx")))
    rows = known.join(bucket, "key").withColumn("in_major", F.col("component") == F.col("major")).drop("major")
    return materialize(rows.join(classes.select("cid", "n", "sketch"), "cid"), "near-open")


def _tiles(rows: DataFrame, *more: str) -> DataFrame:
    """key, band, xs, ys: square tiles of each open bucket.

    Members are packed in blocks of about ``TILE``, once for each side, and blocks meet blocks: a
    tile pairs a block of members outside the bucket's largest component (x) with one of all
    its members (y)."""
    def blocks(side: str, chosen: DataFrame) -> DataFrame:
        spread = F.pmod(F.xxhash64("cid"), F.col(f"b{side}")).alias("block")
        one = F.struct("cid", "component", "in_major", "n", "sketch", *more)
        return chosen.groupBy("key", "band", spread).agg(F.collect_list(one).alias(f"{side}s")).drop("block")
    return blocks("x", rows.where(~F.col("in_major"))).join(blocks("y", rows), ["key", "band"])


def _opened(batch: pa.RecordBatch) -> pa.Table:
    """The members of a batch's tiles, one row each and tile by tile, with their tile and side."""
    sides = []
    for name in ("xs", "ys"):
        lists = batch.column(name)
        held, size = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False)
        tile = np.repeat(np.arange(batch.num_rows), size)
        fields = {held.type.field(i).name: x for i, x in enumerate(held.flatten())}
        sides.append(pa.table({"tile": tile, "is_x": np.full(len(tile), name == "xs"), "band": batch.column("band").take(pa.array(tile)), **fields}))
    rows = pa.concat_tables(sides)
    return rows.take(pa.array(np.argsort(rows.column("tile").to_numpy(), kind="stable"))).combine_chunks()


def _runs(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """The tiles of a batch, some at a time."""
    for start in range(0, batch.num_rows, 256):
        yield _opened(batch.slice(start, 256))


def _tile_pairs(rows: pa.Table, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, row, estimate) of plausible pairs of different components, in runs.

    A pair that shares several bands is met in the first of them only.
    """
    tile, cid, component, n, band = (rows.column(x).to_numpy() for x in ("tile", "cid", "component", "n", "band"))
    is_x, in_major = rows.column("is_x").to_numpy(), rows.column("in_major").to_numpy()
    sketch = _matrix(rows.column("sketch").combine_chunks())
    starts = np.concatenate(([0], np.flatnonzero(np.diff(tile)) + 1, [len(tile)]))
    tile_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    xs, ys = np.flatnonzero(is_x), np.flatnonzero(~is_x)
    first = np.searchsorted(tile_of[ys], np.arange(len(starts)))
    count = (first[1:] - first[:-1])[tile_of[xs]]
    at = 0
    while at < len(xs):  # runs of x rows with a bounded number of pairs
        stop = max(at + 1, int(np.searchsorted(np.cumsum(count[at:]), 40_000, side="right")) + at)
        left = np.repeat(xs[at:stop], count[at:stop])
        right = ragged(ys, first[tile_of[xs[at:stop]]], count[at:stop])
        at = stop
        # Two rows outside the largest component meet twice; the smaller id goes first.
        use = (component[left] != component[right]) & (in_major[right] | (cid[left] < cid[right]))
        small, large = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
        use &= small >= least * large
        left, right = left[use], right[use]
        equal = sketch[left] == sketch[right]
        near = equal.sum(axis=1) >= least * REGISTERS  # equal registers are at least as likely as similarity
        bands = equal[near][:, :REGISTERS // BAND_ROWS * BAND_ROWS].reshape(-1, REGISTERS // BAND_ROWS, BAND_ROWS).all(axis=2).argmax(axis=1)
        left, right = left[near], right[near]
        here = bands == band[left]
        left, right = left[here], right[here]
        value = estimate(sketch[left], sketch[right], n[left].astype(float), n[right].astype(float)) if len(left) else np.zeros(0)
        good = value >= least
        yield left[good], right[good], value[good]


def _rest_links(docs: DataFrame, classes: DataFrame, members: DataFrame, components: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between components within buckets, written. Pairs never leave their tile: it
    names the members that have a plausible partner, gets their texts, and verifies."""
    least = percent / 100 - ESTIMATE_SLACK
    open_ = _open_members(members, components, classes)

    def involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (x for batch in batches for x in _runs(batch)):
            seen = np.zeros(rows.num_rows, bool)
            for left, right, _ in _tile_pairs(rows, least):
                seen[left] = seen[right] = True
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(rows.column("cid").to_numpy()[seen]))], names=["cid"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (x for batch in batches for x in _runs(batch)):
            cid, component = rows.column("cid").to_numpy(), rows.column("component").to_numpy()
            packed, sets, parent, links = rows.column("packed"), {}, {}, []

            def root(x):
                while parent.get(x, x) != x:
                    x = parent[x]
                return x
            for left, right, value in _tile_pairs(rows, least):
                order = np.argsort(-value, kind="stable")  # the likeliest link of two components first; the others are then not needed
                for i, j in zip(left[order].tolist(), right[order].tolist()):
                    a, b = root(component[i]), root(component[j])
                    if a == b:
                        continue
                    for k in (i, j):
                        if cid[k] not in sets:
                            text = pa.array([zstandard.decompress(packed[k].as_py()).decode()], pa.string())
                            sets[cid[k]] = shingle_sets(text, width)[0]
                    x, y = sets[cid[i]], sets[cid[j]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        parent[max(a, b)] = min(a, b)
                        links.append((cid[i], cid[j]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

    ids = materialize(_tiles(open_).mapInArrow(involved, "cid long").distinct(), "near-involved")
    wanted = materialize(classes.select("cid", "doc_id", "h1", "h2").join(ids, "cid"), "near-wanted")
    texts = materialize(_texts(docs, wanted), "near-texts")
    return materialize(_tiles(open_.join(texts, "cid"), "packed").mapInArrow(verify, "a long, b long"), "near-links")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    signed = materialize(_signatures(docs, width), "near-signatures")
    classes = (signed.where(F.col("n") > 0).groupBy("h1", "h2")
               .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    # Written, so that the ids given here stay what they are.
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "near-classes")
    comparable = classes.where(F.col("doc_id").isNotNull())
    bands = _bands(comparable)
    hubs = bands.groupBy("key").agg(F.min("cid").alias("hub"), F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    members = materialize(bands.join(hubs.select("key", "hub"), "key"), "near-buckets")
    stars = members.where(F.col("cid") != F.col("hub")).select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()
    links = _links(docs, comparable, stars, width, percent)
    components = materialize(connected_components(links), "near-components")
    more = _links(docs, comparable, _other_hubs(members, components, links), width, percent)
    if not more.isEmpty():
        links = links.unionByName(more)
        components = materialize(connected_components(links), "near-components")
    rest = _rest_links(docs, comparable, members, components, width, percent)
    if not rest.isEmpty():
        links = links.unionByName(rest)
        components = materialize(connected_components(links), "near-components")
    grouped = comparable.select("cid", "doc_id", "h1", "h2").join(components.withColumnRenamed("node", "cid"), "cid", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "cid"))
    smallest = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = grouped.join(smallest, "component").select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "component_id")
    out = signed.select("doc_id", "h1", "h2", "n").join(named, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")) & (F.col("n") > 0), "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"),
                      (own.isNull() | (F.col("doc_id") == own)).alias("kept"))


def filter_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, and all documents without words, with all their columns."""
    found = materialize(near_duplicates(docs, width, percent), "near-verdicts")
    gone = materialize(found.where(~F.col("kept")).select("doc_id").distinct(), "near-gone")
    kept = docs.join(sized_broadcast(gone), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    again = found.where(F.col("kept") & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1")
    again = materialize(again.select("doc_id"), "near-repeated")
    if again.isEmpty():
        return kept
    once = kept.join(sized_broadcast(again), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(sized_broadcast(again), "doc_id", "left_anti").unionByName(once).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_setsketch_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlens.llm.common import documents
    return near_duplicates(documents(spark, sf_dir), width=4, percent=80)
