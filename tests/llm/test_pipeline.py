import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from orderlens.llm.queries import ORACLES, QUERIES
from orderlens.sources.files import materialize
from tests.conftest import SF


def test_stages_keep_the_columns_and_filter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, seen, SF), name)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert out.select("doc_id").join(seen, "doc_id", "left_anti").count() == 0
        if name == "line_dedup":
            assert out.count() == seen.count()
            lines = out.select(F.explode(F.split("text", "\n")).alias("x")).where("trim(x) <> ''")
            assert lines.count() == lines.distinct().count()
            assert out.where(F.col("n_chars") != F.length("text")).isEmpty()
        seen = out
    assert seen.join(marks.where("quality = 1 and toxic = 0"), "doc_id").count() > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, seen, SF)
    assert packed.select("doc_id").distinct().count() == seen.count()


def test_run_equals_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "line_dedup", "near_dedup", "packing"]


@pytest.mark.parametrize("rows", ["awkward", "empty"])
def test_awkward_documents_pass(spark, request, rows):
    docs = request.getfixturevalue(rows)
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), name)
        if name != "packing":
            assert out.columns == docs.columns
        docs = out


def test_every_operator_is_registered():
    import __spark_entry__
    queries = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(queries)
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES) and set(__spark_entry__.oracle_sql()) <= set(queries)
