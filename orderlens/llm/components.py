"""Connected components by alternating large and small stars (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.sources.files import materialize


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component (its smallest node) of every node on a link ``(a, b)``.

    Each round joins nodes to the smallest neighbour; the written rounds are the lineage
    cuts. Neighbourhoods are only ever reduced to their minimum, so a node with very many
    links is aggregated map-side and its join is one that Spark can split.
    """
    edges = materialize(_sound(links.select("a", "b")), "links")
    state = _state(edges)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: every greater neighbour goes to the smallest node around.
        large = _sound(both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = materialize(large, "large-star")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        # Small star: a node and its smaller neighbours go to the smallest of them.
        joined = down.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = materialize(_sound(small), "small-star")
        now = _state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))


def _sound(links: DataFrame) -> DataFrame:
    """Each link once, from the greater to the smaller node, without loops and nulls."""
    return (links.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
