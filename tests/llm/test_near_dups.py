import random

import numpy as np
import pytest

from orderlens.llm import near_dups
from orderlens.llm.components import connected_components
from tests.conftest import SF
from tests.llm.brute import components, shingles


def _check(rows, docs, width):
    """Against brute force; every row an id of its own."""
    docs = sorted(docs)
    sets = [shingles(text, width) for _, text in docs]
    found = components(sets)
    expected = {doc: docs[found[i]][0] for i, (doc, _) in enumerate(docs)}
    got = {r["doc_id"]: r for r in rows}
    assert {d: r["component_id"] for d, r in got.items()} == expected
    assert {d: r["n_shingles"] for d, r in got.items()} == {d: len(s) for (d, _), s in zip(docs, sets)}
    assert all(r["kept"] == (d == expected[d]) for d, r in got.items())


def test_query_by_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    _check(near_dups.op4_setsketch_near_dups(spark, SF).collect(), docs, 4)


@pytest.mark.parametrize("tile", [512, 32])
def test_a_large_group_of_uneven_copies(spark, monkeypatch, tile):
    monkeypatch.setattr(near_dups, "TILE", tile)
    rng = random.Random(4)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(200)]
    docs = []
    for i in range(400):  # similarity to the common source from 0.5 to 1, with exact copies and chains among them
        text = list(words)
        for _ in range(rng.randrange(0, 13)):
            text[rng.randrange(200)] = f"x{rng.randrange(60)}"
        docs.append((i, " ".join(text)))
    docs += [(1000 + i, " ".join(f"y{rng.randrange(10 ** 6)}" for _ in range(60))) for i in range(200)]
    docs += [(2000 + i, "one shared passage of quite a few words that everybody has " + f"z{i} " * 3) for i in range(100)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    _check(near_dups.near_duplicates(frame, 4, 80).collect(), docs, 4)


def test_awkward_documents(awkward, empty):
    rows = near_dups.near_duplicates(awkward).collect()
    found = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in rows}
    assert len(rows) == awkward.count()
    assert found[1, 12] == (1, True) and found[2, 12] == (1, False)
    assert found[3, 0] == (3, True) and found[4, 0] == (4, True) and found[5, 0] == (5, True)
    assert found[None, 0] == (None, True) and found[None, 7] == (None, True)
    assert found[6, 4] == (6, True)
    assert near_dups.near_duplicates(empty).count() == 0
    kept = near_dups.filter_documents(awkward)
    assert kept.schema == awkward.schema
    assert sorted((r["doc_id"] or 0 for r in kept.collect())) == [0, 0, 1, 3, 4, 5, 6, 7]
    assert near_dups.filter_documents(empty).count() == 0


def test_repeated_rows_leave_one(spark):
    text = "ten words make a text that is long enough here"
    docs = spark.createDataFrame([(5, text), (5, text), (9, text), (7, "")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_dups.filter_documents(docs).collect()) == [5, 7]


@pytest.mark.parametrize("similarity", [0.3, 0.6, 0.8, 0.95])
def test_sketches_merge_and_estimate(similarity):
    rng = np.random.default_rng(7)
    errors = []
    for _ in range(25):
        n = 600
        shared = round(2 * n * similarity / (1 + similarity))
        pool = rng.integers(0, 2 ** 63, 2 * n - shared).astype(np.uint64)
        a, b = pool[:n], pool[n - shared:]
        x, y = near_dups.registers(a), near_dups.registers(b)
        assert (near_dups.registers(pool) == np.maximum(x, y)).all()
        value = near_dups.estimate(x[None], y[None], np.array([float(len(a))]), np.array([float(len(b))]))[0]
        errors.append(value - shared / len(pool))
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < near_dups.ESTIMATE_SLACK


def test_components_of_random_links(spark):
    rng = random.Random(9)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000 + i) for i in range(1, 90)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_equals_its_sql(spark):
    import duckdb

    from orderlens.llm.queries import ORACLES
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    rows = con.sql(ORACLES["op4_setsketch_near_dups"]).fetchall()
    assert sorted(rows) == sorted(map(tuple, near_dups.op4_setsketch_near_dups(spark, SF).collect()))
