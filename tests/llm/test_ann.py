import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import ann
from tests.conftest import SF


def _expected(rows, is_query, k=5):
    good = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good.setdefault(i, []).append(np.array(v, float))
    out = {}
    for q, own in good.items():
        if is_query(q):
            near = {}
            for i, vectors in good.items():
                for a in own:
                    for b in vectors:
                        if i != q and len(a) == len(b):
                            near[i] = max(near.get(i, -2), round(float((a / np.linalg.norm(a)) @ (b / np.linalg.norm(b))), 12))
            if near:
                out[q] = sorted(near.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def _got(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(found) + 1
        found.append((r["vec_id"], round(r["score"], 12)))
    return out


def test_query_by_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, expected = _got(ann.op6_int8_block_neighbours(spark, SF)), _expected(rows, lambda i: i % 50 == 0)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in expected.items()}
    assert all(a == pytest.approx(b) for q in got for (_, a), (_, b) in zip(got[q], expected[q]))


def test_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "CANDIDATE_BLOCK", 7)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(0)
    few = rng.normal(size=(14, 4)).tolist()
    rows = [(i, few[rng.integers(14)]) for i in range(1, 60)]  # few vectors: many ties
    rows += [(2, rows[1][1]), (2, [9.0, 1.0, 0.0, 0.0]), (None, [1.0] * 4), (100, None), (101, []), (102, [0.0] * 4), (103, [1.0, None, 0.0, 0.0]),
             (104, [float("nan"), 0.0, 0.0, 1.0]), (105, [float("inf"), 0.0, 0.0, 1.0]), (106, [1.0, 2.0]), (108, [2.0, 1.0]), (110, [5.0]),
             (112, [1e-200, 0.0, 0.0, 1e-200]), (114, [1e200, 0.0, 0.0, 1e200])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("score", "rank", "dim", "label")})
    expected = _expected([r for r in rows if r[0] not in (112, 114)], lambda i: i % 2 == 0)
    got = _got(ann.nearest(frame.where("vec_id is null or vec_id not in (112, 114)"), F.col("vec_id") % 2 == 0))
    assert got == expected
    assert (114, 1.0) in _got(ann.nearest(frame, F.col("vec_id") == 112))[112]
    assert ann.nearest(frame.limit(0), F.lit(True)).count() == 0
    assert ann.nearest(frame.where("vec_id = 110"), F.lit(True)).count() == 0
