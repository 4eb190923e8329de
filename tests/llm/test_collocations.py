import collections
import random
import re

import numpy as np
import pytest

from orderlens.llm import collocations
from tests.conftest import SF
from tests.llm.brute import LOWER

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, min_count, max_words=5, top=2000):
    """Every n-gram counted as a tuple of words."""
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    inside = {(lang, w[i:j]) for (lang, w), a in candidates.items() for i in range(len(w)) for j in range(i + 2, len(w) + 1)
              if j - i < len(w) and a >= f[lang, w[i:j]]}
    by_lang = collections.defaultdict(list)
    for (lang, w), a in candidates.items():
        if (lang, w) not in inside:
            score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            by_lang[lang].append((-score, -a, " ".join(w).encode(), (a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score)))
    return sorted((lang, rank, phrase.decode(), *rest) for lang, found in by_lang.items()
                  for rank, (_, _, phrase, rest) in enumerate(sorted(found)[:top], 1))


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def texts(spark):
    random.seed(11)
    pool = ["a", "b", "A", "c", "é", "É", "日本", "\x1c", "x\x85y", "new", "york", "city", " ", "zz"]
    gaps = [" ", " ", " ", "\t", "  ", ", ", ".", "\n", " ?", "\x0b"]
    rows = [("".join(random.choice(pool) + random.choice(gaps) for _ in range(random.randint(0, 60))), random.choice(["en", "fr", None, "und"]))
            for _ in range(120)]
    rows += [("New York City is new york city", "en")] * 9 + [(None, "en"), ("", None), ("a b " * 5000, "fr")]
    return spark.createDataFrame(rows, "text string, lang string").repartition(3), rows


@pytest.mark.parametrize("min_count, max_words, top", [(3, 5, 2000), (9, 4, 12), (1, 2, 7)])
def test_equals_brute_force(texts, min_count, max_words, top):
    docs, rows = texts
    assert rows_of(collocations.mine(docs, min_count, max_words, top)) == brute(rows, min_count, max_words, top)


def test_small_blocks_and_partitions_find_the_same(texts, monkeypatch):
    docs, rows = texts
    monkeypatch.setattr(collocations, "PARTITION_MASS", 500)
    monkeypatch.setattr(collocations, "MERGE_AT", 10)
    monkeypatch.setattr(collocations, "HELD_HASHES", 50)
    monkeypatch.setattr(collocations, "HELD_PHRASES", 20)
    monkeypatch.setattr(collocations, "MAX_BITS", 1 << 10)  # a full bitmap lets everything through
    assert rows_of(collocations.mine(docs, 4)) == brute(rows, 4)


def test_summary_keeps_every_frequent_hash_however_merged():
    rng = np.random.default_rng(3)
    stream = np.concatenate((rng.integers(0, 20_000, 60_000), np.repeat(np.arange(90_000, 90_030), 100))).astype(np.uint64)
    rng.shuffle(stream)
    capacity = len(stream) // 100 + 1
    parts = []
    for piece in np.array_split(stream, 7):
        part = collocations.Summary(capacity)
        for chunk in np.array_split(piece, 5):
            part.merge(*np.unique(chunk, return_counts=True))
        parts.append(part)
    while len(parts) > 1:
        a, b = parts.pop(0), parts.pop(0)
        a.merge(b.hashes, b.counts, b.taken)
        parts.append(a)
    whole = parts[0]
    assert whole.taken < 100 and len(whole.hashes) <= capacity
    true = dict(zip(*np.unique(stream, return_counts=True)))
    assert {int(h) for h, n in true.items() if n >= 100} <= set(whole.survivors(100).tolist())
    assert all(0 <= true[h] - n <= whole.taken for h, n in zip(whole.hashes, whole.counts.tolist()))


def test_scores_beyond_64_bits(spark):
    big = 4_000_000_000_000
    words = spark.createDataFrame([("en", "a", big), ("en", "b", big - 1)], "lang string, phrase string, f long")
    pairs = spark.createDataFrame([("en", "a b", 2, big - 7)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("en", big * 100)], "lang string, n long")
    got = collocations.scored(pairs, words, totals).first()
    assert (got["l"], got["r"], got["score"]) == (big, big - 1, 1000 * (big - 7) * big * 100 // (big * (big - 1)))


def test_awkward_documents(awkward, empty):
    rows = [(r["text"], r["lang"]) for r in awkward.select("text", "lang").collect()]
    assert rows_of(collocations.mine(awkward, 2)) == brute(rows, 2)
    assert collocations.mine(empty).count() == 0


def test_query_reads_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    assert rows_of(collocations.op13_phrase_collocations(spark, SF)) == brute(rows, 100)
