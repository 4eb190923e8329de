import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from orderlens.llm import packing
from tests.conftest import SF


def _tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def _check(rows, capacity=2048):
    """Gapless sequences within the capacity; returns their number."""
    rows = rows.sort_values(["sequence_id", "offset"])
    end = rows["offset"] + rows["length"]
    following = rows.groupby("sequence_id")["offset"].shift(-1)
    assert (following.dropna() == end[following.notna()]).all()
    assert (rows.groupby("sequence_id")["offset"].min() == 0).all()
    assert rows.groupby("sequence_id")["length"].sum().max() <= capacity
    return rows["sequence_id"].nunique()


def test_encode_equals_the_library():
    random.seed(3)
    parts = ["a", "b", " ", "  ", "\n", " \n", "\t", "é", "²", "'s", " ", "　", "<|endoftext|>", "<|", "1", "##", "\x1c", "\x85", "日本",
             "́", "x y z", " hello world", "\r\n", "\x0b"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 12))) for _ in range(4000)]
    ids, n = packing.encode(pa.array(texts))
    ends = np.concatenate(([0], np.cumsum(n)))
    tokenizer = _tokenizer()
    for k, text in enumerate(texts):
        assert ids[ends[k]:ends[k + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_item_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 2048])
    counts = {rng.randint(1, capacity): rng.randint(1, 400) for _ in range(rng.randint(1, 60))}
    placed = {}
    runs = sorted(packing.plan(counts, capacity))
    for i, (size, rank, each, seq, offset) in enumerate(runs):
        stop = runs[i + 1][1] if i + 1 < len(runs) and runs[i + 1][0] == size else counts[size]
        for r in range(rank, stop):
            placed[size, r] = (seq + (r - rank) // each, offset + (r - rank) % each * size)
    assert len(placed) == sum(counts.values())
    bins = {}
    for (size, _), (seq, offset) in placed.items():
        bins.setdefault(seq, []).append((offset, size))
    for items in bins.values():
        at = 0
        for offset, size in sorted(items):
            assert offset == at
            at += size
        assert at <= capacity and sum(3 * s > capacity for _, s in items) <= 2
    bound = max(-(-sum(k * n for k, n in counts.items()) // capacity), sum(n for k, n in counts.items() if 2 * k > capacity))
    assert len(bins) <= 1.25 * bound + 1


def test_awkward_documents(awkward, empty):
    rows = packing.pack_documents(awkward).toPandas()
    _check(rows)
    tokenizer = _tokenizer()
    expected = []
    for r in awkward.select("doc_id", "text").collect():
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        n = -(-len(ids) // 2048)
        for piece in range(n):
            a, b = max(0, len(ids) - (n - piece) * 2048), len(ids) - (n - 1 - piece) * 2048
            expected.append((r["doc_id"], piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    got = [(None if x[0] != x[0] else int(x[0]), *x[1:]) for x in rows[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert packing.pack_documents(empty).count() == 0


def test_ids_are_the_pieces(awkward):
    rows = packing.pack_documents(awkward, with_ids=True).toPandas()
    for ids, length, crc in zip(rows["ids"], rows["length"], rows["ids_crc32"]):
        assert len(ids) == length and zlib.crc32(np.array(ids, "<u4").tobytes()) == crc


def test_query_is_near_the_bound(spark):
    rows = packing.op1_best_fit_packing(spark, SF).toPandas()
    assert _check(rows) <= 1.01 * -(-rows["length"].sum() // 2048) + 1
    assert rows["doc_id"].nunique() == 200
