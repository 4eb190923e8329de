import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import quality_rules
from tests.conftest import SF
from tests.llm.brute import WORD


def _base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often = collections.Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    base = (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside))
    return (*base, len(words) < 50 or 100 * len(inside) > 50 * len(words))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in quality_rules.op8_adaptive_rules(spark, SF).collect()}
    for r in docs.collect():
        assert tuple(got[r["doc_id"]][c] for c in COLUMNS) == _base(r["text"])
    assert not any(r["kept"] and r["base_failed"] for r in got.values())


def test_verdicts_follow_labels(spark):
    sf = SF.replace("0.001", "0.01")
    marks = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")
    found = quality_rules.op8_adaptive_rules(spark, sf).toPandas().set_index("doc_id").join(marks, how="inner")
    found = found[~found["base_failed"]]
    assert found[found["quality"] == 1]["kept"].mean() > 0.98
    assert found[found["quality"] == 0]["kept"].mean() < 0.1


def test_awkward_documents(awkward, empty):
    got = sorted((tuple(r) for r in quality_rules.quality_rules(awkward).select("doc_id", *COLUMNS).collect()), key=repr)
    assert got == sorted(((r["doc_id"], *_base(r["text"])) for r in awkward.collect()), key=repr)
    assert quality_rules.quality_rules(empty).count() == 0
    kept = quality_rules.filter_documents(awkward)
    assert kept.columns == awkward.columns and kept.schema == awkward.schema
    assert quality_rules.filter_documents(empty).count() == 0


def test_sketches_merge_and_bound_quantiles(spark):
    rng = np.random.default_rng(1)
    values = rng.lognormal(0, 1, 4000)
    rows = spark.createDataFrame([(str(i % 3), float(v)) for i, v in enumerate(values)], "lang string, value double")
    fake = F.struct(F.lit(100).alias("n_words"), F.lit(0).alias("n_repeat_words"), *[F.col("value").alias(x) for x in quality_rules.RULES])
    sketch = quality_rules.sketches(rows.select("lang", F.lit(None).cast("string").alias("source"), fake.alias("stats")))
    merged = quality_rules.quantile(sketch, ["rule"], {"q": 0.75}).first()
    assert merged["n"] == 4000
    assert merged["q"] == pytest.approx(np.quantile(values, 0.75), rel=0.03)
    parts = quality_rules.quantile(sketch, ["lang", "source", "rule"], {"q": 0.5}).where("rule = 'word_length'").collect()
    for r in parts:
        assert r["q"] == pytest.approx(np.quantile(values[int(r["lang"])::3], 0.5), rel=0.03)


def test_thresholds_are_each_groups_own(spark):
    docs = spark.range(1200).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), (F.col("id") % 2).cast("string").alias("source"), F.concat_ws(
        " ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(F.when(F.col("id") % 2 == 0, F.lit("#")).otherwise(F.lit("")), F.lit("w"),
                                                                              k.cast("string"), F.lit("x"), F.col("id").cast("string")))).alias("text"))
    rows = quality_rules.with_stats(docs, "stats").drop("text")
    limits = {r["source"]: r["symbol_ratio"] for r in quality_rules.fences(quality_rules.sketches(rows)).collect()}
    assert limits["0"] > limits["1"]
