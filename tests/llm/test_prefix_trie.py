import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from orderlens.llm import prefix_trie as trie
from tests.conftest import SF

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The whole trie by a dictionary of prefixes."""
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0), tie, (role, text)))
    own = {c: [t for _, _, t in sorted(x)] for c, x in turns.items()}
    members = collections.defaultdict(list)
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        path = tuple(own.get(base, [])[:h] + x[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path) == d))
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for path in sorted(members, key=len, reverse=True):
        leaves[path] += not children[path]
        saved[path] += (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
        if path:
            children[path[:-1]] += 1
            leaves[path[:-1]] += leaves[path]
            saved[path[:-1]] += saved[path]
    return sorted((min(c for c, _ in m), len(path), min(c for c, _ in members[path[:-1]]) if path else None, len(m), children[path], leaves[path],
                   saved[path], hashlib.sha256(",".join(str(c) for c in sorted(c for c, e in m if e)).encode()).hexdigest())
                  for path, m in members.items())


def nodes_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(3)
    rows = []
    for conv in [*range(0, 260), *range(400, 520), 1000, 1001, 1099, -5, -200, 10 ** 12 + 7]:
        length = rng.choice([0, 1, 2, 3, 4, 8, 30])
        start = rng.choice(["hi", "hi", "hi", "日本", ""])
        for k in range(length):
            text = start if k == 0 else rng.choice(["a", "a", "a", "bb", "é", None])
            rows.append((conv, rng.choice([k, k, None]) if k < 2 else k, rng.choice(["user", "user", None]), text))
    rows += [(700 + i, k, "user", "the same") for i in range(90) for k in range(7)]      # copies
    rows += [(300, k, "user", str(k)) for k in range(400)] + [(301, k, "user", str(k)) for k in range(400)]  # long ones
    rows += [(None, 0, "user", "lost"), (2, 0, "user", "twice"), (2, 0, "user", "twice")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5), rows


@pytest.mark.parametrize("limit", [4096, 2, 7])
def test_equals_brute_force(talks, limit, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_NODES", 200)
    monkeypatch.setattr(trie, "CHUNK", 8)
    df, rows = talks
    assert nodes_of(trie.prefix_trie(df, limit)) == brute(rows)


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(1)
    for size in (0, 1, 2, 1000, 20_000):
        high, low = rng.integers(-2 ** 63, 2 ** 63, size), rng.integers(-3, 3, size)
        table = trie.PerfectHash(high, low)
        assert sorted(table(high, low).tolist()) == list(range(size))
        assert (table(high, low + 100) == -1).all()


def test_equal_digests_of_different_prefixes_are_refused():
    with pytest.raises(ValueError):
        trie.PerfectHash(np.array([5, 5]), np.array([9, 9]))


def test_components_are_bounded(talks):
    df, _ = talks
    rows = trie.prefixes(trie.rebuilt(df))
    for r in trie.nodes(rows, 5).groupBy("tier", "r1", "r2", "depth").count().collect():
        assert r["count"] <= 5


def test_other_columns_and_empty_table(talks):
    from pyspark.sql import functions as F
    df, rows = talks
    clashing = df.withColumns({c: F.lit(1) for c in ("base", "place", "depth", "n", "p1", "tier", "child", "chars", "my col")})
    assert nodes_of(trie.prefix_trie(clashing)) == brute(rows)
    assert trie.prefix_trie(df.limit(0)).collect() == []


def test_query_covers_all_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes_of(trie.op11_prefix_trie(spark, SF)) == brute(rows)
