import collections
import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderlens.llm import lm_score, quality_crf, toxicity
from tests.conftest import SF
from tests.llm.brute import WORD, auc

MIDDLE = SF.replace("0.001", "0.1")


@pytest.mark.parametrize("query, label, fold, held, cut, least", [
    (toxicity.op10_kneser_ney_toxicity, "toxic", 4, 2, 0.3, 0.93),
    (quality_crf.op2_line_crf_quality, "quality", 3, 1, 0.5, 0.985),
])
def test_held_out_accuracy(spark, query, label, fold, held, cut, least):
    marks = spark.read.parquet(f"{MIDDLE}/labels.parquet").toPandas().set_index("doc_id")
    found = query(spark, MIDDLE).toPandas().set_index("doc_id")
    assert len(found) == 10_000 and found["score"].between(0, 1).all()
    assert (found["predicted"] == (found["score"] >= cut)).all()
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % fold == held for i in found.index]).all()
    both = found.join(marks, how="inner")
    both = both[both["held_out"]]
    assert auc(both["score"].tolist(), both[label].tolist()) > least
    assert (both["predicted"] == both[label]).mean() > 0.96


def test_awkward_documents(awkward, empty, marks):
    model, chain = toxicity.fit(awkward, marks), quality_crf.fit(awkward, marks)
    for scored in (toxicity.score_documents(awkward.select("doc_id", "text"), model, "score"), quality_crf.score_documents(awkward, chain)):
        rows = scored.collect()
        assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}) == 1
    assert toxicity.filter_documents(awkward, model).schema == awkward.schema
    assert quality_crf.label_lines(awkward, chain).where("doc_id = 1").count() == 2
    assert toxicity.score_documents(empty, model).count() == 0 and quality_crf.score_documents(empty, chain).count() == 0
    for one in (marks.where("doc_id < 0"), marks.where("quality = 1")):
        assert toxicity.score_documents(awkward, toxicity.fit(awkward, one)).count() == awkward.count()
        assert quality_crf.score_documents(awkward, quality_crf.fit(awkward, one)).count() == awkward.count()


def test_held_out_rows_are_never_learned_from(spark):
    docs, marks = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "labels"))
    for label, fold, held in (("toxic", 4, 2), ("quality", 3, 1)):
        ids = [r["doc_id"] for r in toxicity.labelled(docs, marks, label, fold, held).collect()]
        assert ids and all(zlib.crc32(str(i).encode()) % fold != held for i in ids)


def test_every_labelled_row_is_learned_from(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    docs = ids.select("doc_id", F.concat(F.lit("w"), F.col("doc_id") % 7).alias("text"))
    marks = ids.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    want = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(20_000))
    assert want > 12_000 and toxicity.labelled(docs, marks).count() == want


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(3)
    lengths = [3, 0, 1, 5]
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    score, first, step = rng.normal(size=sum(lengths)), rng.normal(size=2), rng.normal(size=(2, 2))
    good, steps, total = quality_crf.marginals(score, offsets, first, step)
    want_steps, want_total = np.zeros((2, 2)), []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if a == b:
            continue
        weight = {}
        for y in itertools.product((0, 1), repeat=b - a):
            weight[y] = np.exp(first[y[0]] + sum(score[a + i] * s for i, s in enumerate(y)) + sum(step[p, q] for p, q in zip(y, y[1:])))
        z = sum(weight.values())
        want_total.append(np.log(z))
        for y, w in weight.items():
            for p, q in zip(y, y[1:]):
                want_steps[p, q] += w / z
        for i in range(b - a):
            assert good[a + i] == pytest.approx(sum(w for y, w in weight.items() if y[i]) / z)
    assert np.allclose(steps, want_steps) and sorted(total) == pytest.approx(sorted(want_total))


def test_a_rare_word_tells_less_than_a_frequent_one():
    def ratio(n1, n0):
        return toxicity._log_odds(np.array([float(n1)]), np.array([float(n0)]), np.zeros(1), 0.5)[0]
    assert ratio(1, 0) == pytest.approx(0) and ratio(0, 3) == pytest.approx(0)
    assert ratio(200, 0) > ratio(30, 0) > 0.5 and ratio(10, 20) == pytest.approx(0)


def brute_losses(texts, scored):
    """{row: (background loss, target loss) per word} of ``texts`` (text, in_target, counted), by dictionaries of words and pairs."""
    split = [[w.as_py() for w in toxicity.normal_words(pa.array(WORD.findall(text or ""), pa.string()))] for text, _, _ in texts]
    often = collections.Counter(w for words, (_, _, counted) in zip(split, texts) if counted for w in words)
    numbered = [[w if often[w] >= lm_score.MIN_COUNT else "<unknown>" for w in words] for words in split]
    size = sum(n >= lm_score.MIN_COUNT for n in often.values())

    def counts(skip, only_target):
        one, history, pair = collections.Counter(), collections.Counter(), collections.Counter()
        for i, words in enumerate(numbered):
            if i != skip and texts[i][2] and (texts[i][1] or not only_target):
                before = ["<start>", *words][:len(words)]
                one.update(words)
                history.update(before)
                pair.update(zip(before, words))
        return one, history, pair
    tokens = [sum(counts(None, t)[0].values()) for t in (False, True)]
    out = {}
    for i in scored:
        words, losses = numbered[i], []
        for m in (0, 1):
            one, history, pair = counts(i, m == 1)
            scale = tokens[1] / tokens[0] if m == 0 else 1.0
            mass, loss = scale * sum(one.values()), 0.0
            for v, w in zip(["<start>", *words], words):
                p = (scale * one[w] + lm_score.UNIGRAM_BACKOFF / (size + 1)) / (mass + lm_score.UNIGRAM_BACKOFF)
                loss -= np.log((scale * pair[v, w] + lm_score.BACKOFF * p) / (scale * history[v] + lm_score.BACKOFF))
            losses.append(loss / max(len(words), 1))
        out[i] = losses
    return out


@pytest.mark.parametrize("block_bytes, keys", [(8 << 20, 1_000_000), (20_000, 500)])
def test_losses_by_brute_force(spark, monkeypatch, block_bytes, keys):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(lm_score, "PARTITION_KEYS", keys)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    marked = lm_score.with_target(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    marked = marked.withColumn("counted", F.col("doc_id") % 7 != 0).cache()
    texts = [(r["doc_id"], r["text"], r["in_target"], r["counted"]) for r in marked.collect()]
    rows = {r["doc_id"]: r for r in lm_score.score_documents(marked).collect()}
    assert len(rows) == len(texts) and any(not t[3] for t in texts)
    some = [i for i, t in enumerate(texts) if t[3]][:5] + [i for i, t in enumerate(texts) if not t[3]][:3]
    for i, (background, target) in brute_losses([t[1:] for t in texts], some).items():
        row = rows[texts[i][0]]
        assert (row["background_loss"], row["target_loss"]) == (pytest.approx(background, rel=1e-9), pytest.approx(target, rel=1e-9))
        assert row["score"] == pytest.approx(background - target, abs=1e-9)


def test_no_cap_on_words_or_pairs(spark):
    """Every word that is frequent enough is in the vocabulary, however many there are."""
    rows = [(i, " ".join(f"w{j}" for j in range(i % 2, 80_000, 2))) for i in range(2 * lm_score.MIN_COUNT)]
    marked = spark.createDataFrame(rows, "doc_id long, text string").withColumn("in_target", F.col("doc_id") % 2 == 0)
    got = {r["doc_id"]: r for r in lm_score.score_documents(marked).collect()}
    # each known word's own count, less the document's, tells the two halves apart
    assert all((got[i]["score"] > 0.5) == (i % 2 == 0) for i in got)
    assert {r["n_words"] for r in got.values()} == {40_000}


def test_language_models_on_awkward_documents(awkward, empty, marks):
    marked = lm_score.with_target(awkward, marks)
    rows = lm_score.score_documents(marked).collect()
    assert len(rows) == awkward.count()
    assert all(r["score"] == 0 and r["n_words"] == 0 for r in rows if r["doc_id"] in (3, 4, 5))
    nothing = lm_score.with_target(awkward, marks.where("doc_id < 0"))
    assert {round(r["score"], 9) for r in lm_score.score_documents(nothing).collect()} == {0.0}
    assert lm_score.score_documents(lm_score.with_target(empty, marks)).count() == 0


def test_good_documents_score_higher(spark):
    sf = SF.replace("0.001", "0.01")
    marks = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")
    found = lm_score.op7_cross_entropy_difference(spark, sf).toPandas().set_index("doc_id").join(marks, how="inner")
    assert auc(found["score"].tolist(), found["quality"].tolist()) > 0.68


def test_texts_without_a_label_stay_out_of_the_join(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))
    ids = docs.where("doc_id % 100 = 0 or doc_id = 39999").select("doc_id", F.lit(1).alias("label"))
    kept = {r[0] for r in toxicity.with_ids_of(docs, ids).select("doc_id").collect()}
    assert {r[0] for r in ids.select("doc_id").collect()} <= kept and len(kept) < 500
    other = ids.withColumn("doc_id", F.col("doc_id").cast("int"))  # an id of another type may hash apart
    assert toxicity.with_ids_of(docs, other).count() == 40_000


def test_labelled_rows_match_a_plain_join(spark):
    docs = spark.createDataFrame([(i % 900 if i % 7 else None, f"text {i}") for i in range(1000)], "doc_id long, text string")
    marks = spark.createDataFrame([(i // 2 if i % 5 else None, i % 3) for i in range(1200)], "doc_id long, toxic int")
    usable = marks.where("doc_id is not null and toxic in (0, 1) and crc32(cast(doc_id as string)) % 4 != 2").select("doc_id", "toxic").distinct()
    want = docs.join(usable, "doc_id").select("doc_id", "text", "toxic").collect()
    assert sorted(map(tuple, toxicity.labelled(docs, marks).select("doc_id", "text", "label").collect())) == sorted(map(tuple, want))


def test_no_text_is_written_for_the_fit(spark, monkeypatch):
    from orderlens.sources import files
    written, real = [], files.materialize
    monkeypatch.setattr(files, "materialize", lambda df, name, **kw: (written.append(df.columns), real(df, name, **kw))[1])
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "plain good words").otherwise("plain bad words").alias("text"))
    model = toxicity.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")))
    assert written and not any("text" in columns for columns in written)
    low, high = model.score(pa.array(["plain good words", "plain bad words"]))
    assert low < 0.5 < high
