"""Sharding through fixed virtual slots (DataFrame functions only).

Every record is hashed into one of ``n_slots`` virtual slots; bytes and rows are summed
per slot; a small versioned slot-to-shard map, written as a table, says where each slot
lives. Rebalancing edits that map: records never rehash, whole slots move.

The record hash covers the id and the text, so no id or group of copies that holds a
large share of the rows can fill a slot. The map has ``n_slots`` rows whatever the input,
so it may pass through the driver and be broadcast.

Defined cases: a null text has size 1 (no bytes, plus one) and the crc32 of the empty
text; a null doc_id is hashed as the word "null" and otherwise treated as any row;
repeated rows each get a place of their own; an empty table gives an empty result and a
map in which all slots hold 0 bytes; other columns of the input are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

N_SLOTS = 4096
MAP_SCHEMA = T.StructType([
    T.StructField("version", T.IntegerType(), False),
    T.StructField("virtual_slot", T.IntegerType(), False),
    T.StructField("shard", T.IntegerType(), False),
    T.StructField("bytes", T.LongType(), False),
    T.StructField("rows", T.LongType(), False),
])


def slotted(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot of every record; texts go no further."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(key, text), F.lit(n_slots)).cast("int").alias("virtual_slot"))


def slot_loads(records: DataFrame) -> DataFrame:
    """Bytes and rows of each filled slot (at most ``n_slots`` rows)."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def assign(loads: list[tuple[int, int, int]], n_shards: int, n_slots: int = N_SLOTS) -> list[tuple[int, int, int, int]]:
    """First map: slots by falling bytes, each to the lightest shard. (virtual_slot, shard, bytes, rows)."""
    known = {slot: (size, rows) for slot, size, rows in loads}
    order = sorted(range(n_slots), key=lambda s: (-known.get(s, (0, 0))[0], s))
    heap = [(0, shard) for shard in range(n_shards)]
    out = []
    for slot in order:
        size, rows = known.get(slot, (0, 0))
        load, shard = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, shard))
        out.append((slot, shard, size, rows))
    return out


def rebalance(slots: list[tuple[int, int, int, int]], n_shards: int) -> list[tuple[int, int, int, int]]:
    """Edit a map for new loads or another shard count, moving few slots.

    Slots of shards that no longer exist move first; then, while it narrows the gap, a
    slot of at most half the gap moves from the heaviest to the lightest shard.
    """
    where = {slot: shard for slot, shard, _, _ in slots}
    size = {slot: b for slot, _, b, _ in slots}
    load = dict.fromkeys(range(n_shards), 0)
    for slot, shard in where.items():
        if shard < n_shards:
            load[shard] += size[slot]
    homeless = sorted((s for s, shard in where.items() if shard >= n_shards), key=lambda s: (-size[s], s))
    for slot in homeless:
        where[slot] = min(load, key=lambda x: (load[x], x))
        load[where[slot]] += size[slot]
    for _ in range(4 * len(slots)):
        low, high = min(load, key=lambda x: (load[x], x)), max(load, key=lambda x: (load[x], -x))
        room = (load[high] - load[low]) // 2
        movable = [s for s, shard in where.items() if shard == high and 0 < size[s] <= room]
        if not movable:
            break
        slot = max(movable, key=lambda s: (size[s], -s))
        where[slot] = low
        load[high] -= size[slot]
        load[low] += size[slot]
    return [(slot, where[slot], b, rows) for slot, _, b, rows in slots]


def write_map(spark: SparkSession, slots: list[tuple[int, int, int, int]], path: str, version: int) -> DataFrame:
    """Append one version of the map to the table at ``path``; returns that version."""
    rows = [(version, *x) for x in slots]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return read_map(spark, path, version)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the map, the newest by default."""
    table = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == F.lit(version))


def place(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Shard of every record and its place there, gapless from 0.

    The place is the record's rank within its virtual slot plus the rows of the shard's
    earlier slots, which the map knows: no shard is ever gathered in one task.
    """
    base = F.sum("rows").over(Window.partitionBy("shard").orderBy("virtual_slot")
                              .rowsBetween(Window.unboundedPreceding, -1))
    starts = slot_map.select("virtual_slot", "shard", F.coalesce(base, F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (records.withColumn("rank", rank).join(F.broadcast(starts), "virtual_slot")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("rank") - 1).cast("long").alias("slot"),
                    "virtual_slot"))


def shard_documents(docs: DataFrame, n_shards: int, map_path: str, n_slots: int = N_SLOTS) -> DataFrame:
    """Shard ``docs`` by bytes and store version 1 of the slot map at ``map_path``."""
    spark = docs.sparkSession
    records = slotted(docs, n_slots)
    loads = [tuple(r) for r in slot_loads(records).collect()]  # at most n_slots rows
    return place(records, write_map(spark, assign(loads, n_shards, n_slots), map_path, 1))


def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlens.llm.common import documents
    from orderlens.session import scratch_path
    placed = shard_documents(documents(spark, sf_dir), 16, scratch_path(spark, "slot-map"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
