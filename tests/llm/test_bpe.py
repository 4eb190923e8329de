import hashlib
import random

import pytest

from orderlens.llm import bpe
from tests.conftest import SF


def _expected(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def noise(spark):
    random.seed(5)
    parts = ["a", "b", " ", "\n", "\t", "é", "²", "'s", "'LL", " ", "　", "<|endoftext|>", "<|", "1", "##", "\x1c", "日本", "́", "Σ", "İ",
             "\x85", "ß", "ﬁ", "x y z", " Hello World"]
    rows = [(k, "".join(random.choice(parts) for _ in range(random.randint(0, 12)))) for k in range(1500)]
    return spark.createDataFrame([*rows, (None, None), (None, "x"), (1500, None), (7, rows[7][1])], "doc_id long, text string").repartition(3)


def test_digests_equal_the_library(noise):
    got = sorted(map(tuple, bpe.encode_and_decode(noise).collect()), key=repr)
    expected = []
    for r in noise.collect():
        ids, text = _expected(r["text"])
        expected.append((r["doc_id"], len(ids), _sha(" ".join(map(str, ids))), _sha(text)))
    assert got == sorted(expected, key=repr)


def test_ids_and_decode_join(noise):
    some = noise.where("doc_id < 300")
    encoded = bpe.encode(some, n_buckets=5)
    assert {(r["doc_id"], tuple(r["ids"])) for r in encoded.collect()} == {(r["doc_id"], tuple(_expected(r["text"])[0])) for r in some.collect()}
    assert {tuple(r) for r in bpe.decode(encoded).select("doc_id", "text").collect()} == {(r["doc_id"], _expected(r["text"])[1]) for r in some.collect()}


def test_awkward_documents(awkward, empty):
    got = sorted(map(tuple, bpe.encode_and_decode(awkward).collect()), key=repr)
    expected = []
    for r in awkward.select("doc_id", "text").collect():
        ids, text = _expected(r["text"])
        expected.append((r["doc_id"], len(ids), _sha(" ".join(map(str, ids))), _sha(text)))
    assert got == sorted(expected, key=repr)
    assert bpe.encode_and_decode(empty).count() == 0 and bpe.decode(bpe.encode(empty)).count() == 0


def test_each_word_is_encoded_once(spark, noise):
    words = bpe._block_words(noise.select("doc_id", "text"), 4).toPandas()
    import zstandard
    buckets = {}
    for bucket, packed in zip(words["bucket"], words["words"]):
        for w in zstandard.decompress(packed).decode().split("\n"):
            assert buckets.setdefault(w, bucket) == bucket


def test_query_covers_all_documents(spark):
    assert bpe.op3_distinct_word_bpe(spark, SF).count() == 200
