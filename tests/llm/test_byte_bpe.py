import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from orderlens.llm import byte_bpe
from tests.conftest import SF


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken
    ranks = byte_bpe.Ranks.load(byte_bpe.RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.by_piece, special_tokens={})


def ours(texts):
    return [np.frombuffer(x, "<u4").tolist() for x in byte_bpe.encoded_texts(pa.array(texts, pa.string()))]


def digests(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        out.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode_bytes(ids)).hexdigest()))
    return sorted(out, key=repr)


def test_random_texts_equal_the_library(library):
    random.seed(1)
    parts = ["ab", "a", "b", "aaaa", "the", "é", "日", "本語", "👍", " ", "  ", "\n", "\t", " ", "'s", "'ll", "1", "23", "!", "?!", "ing", "tion", "　", "\x85",
             "xyz", "ABAB", "<|endoftext|>", "\x1c", "İ", "\x00"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 60))) for _ in range(3000)]
    assert ours(texts) == library.encode_ordinary_batch(texts, num_threads=2)


def test_every_space_and_sign_cuts_as_in_the_library(library):
    signs = [chr(c) for c in (*range(0x3100), *range(0xF900, 0xFB00), *range(0xFE00, 0x10000), *range(0x1F300, 0x1F700)) if not 0xD800 <= c < 0xE000]
    texts = ["a%s %sb 1%s2 .%s.  %s\n%s%s" % ((c,) * 7) for c in signs]
    assert ours(texts) == library.encode_ordinary_batch(texts, num_threads=2)


@pytest.mark.parametrize("text", ["a" * 70_001, "ab" * 20_000, "na" * 9_999 + "n", " " * 30_000 + "x", "日本語中文字符" * 3_000, "\n \n" * 5_000,
                                  "".join(random.Random(4).choice("abcdefghijklmnop") for _ in range(60_000))])
def test_very_long_pre_tokens(library, text):
    assert ours([text]) == [library.encode_ordinary(text)]


def plain_merge(by_piece, word):
    """Lowest rank first, leftmost of equals, one pair at a time."""
    if word in by_piece:
        return [by_piece[word]]
    parts = [word[i:i + 1] for i in range(len(word))]
    while True:
        ranked = [(by_piece[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in by_piece]
        if not ranked:
            return [by_piece[p] for p in parts]
        i = min(ranked)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_ranks_in_any_order_merge_leftmost_lowest_first(monkeypatch):
    """Vocabularies in which a merge often makes a pair of a lower rank."""
    rng = random.Random(7)
    for trial in range(40):
        monkeypatch.setattr(byte_bpe, "ROUNDS", rng.choice([1, 2, 8]))
        pieces = {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(30)}
        order = [bytes([b]) for b in range(256)] + sorted(pieces)
        rng.shuffle(order)
        by_piece = {p: i for i, p in enumerate(order)}
        words = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 40))) for _ in range(60)] + [b"a" * 200, b"ab" * 90]
        ids, count = byte_bpe.merge(byte_bpe.Ranks.build(by_piece), words)
        got = [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
        assert got == [plain_merge(by_piece, w) if w else [] for w in words]


def test_queue_finds_the_first_rank():
    queue, rng, held = byte_bpe.RankQueue(50_000), random.Random(2), set()
    for _ in range(3000):
        if held and rng.random() < 0.5:
            assert queue.first() == min(held)
            queue.take(min(held))
            held.remove(min(held))
        else:
            rank = rng.randrange(50_000)
            queue.push(rank, np.array([rank]))
            held.add(rank)
    assert queue.first() == min(held, default=-1)


def test_documents_and_round_trip(spark, library, awkward, empty):
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert sorted(map(tuple, byte_bpe.encode_and_decode(awkward).collect()), key=repr) == digests(library, rows)
    decoded = byte_bpe.decode(byte_bpe.encode(awkward)).collect()
    assert sorted(bytes(r["decoded"]) for r in decoded) == sorted((t or "").encode() for _, t in rows)
    assert byte_bpe.encode_and_decode(empty).count() == 0 and byte_bpe.decode(byte_bpe.encode(empty)).count() == 0


def test_query_covers_all_documents(spark, library):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = byte_bpe.op12_rank_queue_bpe(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == digests(library, rows)
