"""Fitted steps as ML stages: saved, loaded and replaced as one pipeline."""

import os

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler

from orderlens.operators.prep import MeanImputer, MeanImputerModel, Winsorizer, WinsorizerModel
from orderlens.operators.train import gbt
from orderlens.sources.files import load_model, save_model


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, None if i % 7 == 0 else i % 11, float(i * i % 31), float(i % 2), None) for i in range(200)]
    return spark.createDataFrame(data, "id long, a int, b double, label double, `void.col` double")


def fitted(rows, **kw):
    steps = [MeanImputer(["a"]), Winsorizer(["b"], 0.1, 0.9), VectorAssembler(inputCols=["a", "b"], outputCol="features")]
    return Pipeline(stages=[*steps, gbt({"maxDepth": 2, "maxIter": 2, **kw})]).fit(rows)


def answers(model, rows):
    return sorted((r["id"], r["a"], r["b"], r["prediction"], r["void.col"]) for r in model.transform(rows).collect())


def test_one_pipeline_holds_every_step(spark, rows, tmp_path):
    model = fitted(rows)
    path = save_model(model, str(tmp_path / "bundle"))
    again = load_model(PipelineModel, path)
    assert isinstance(again.stages[0], MeanImputerModel) and isinstance(again.stages[1], WinsorizerModel)
    assert again.stages[0].means == model.stages[0].means and again.stages[1].bounds == model.stages[1].bounds
    assert answers(again, rows) == answers(model, rows)


def test_a_second_save_fails_or_replaces_all(spark, rows, tmp_path):
    path = str(tmp_path / "bundle")
    first, second = fitted(rows), fitted(rows.where("id < 60"), stepSize=0.3)
    save_model(first, path)
    with pytest.raises(Exception, match="already exists"):
        save_model(second, path)
    assert load_model(PipelineModel, path).stages[0].means == first.stages[0].means
    save_model(second, path, overwrite=True)
    again = load_model(PipelineModel, path)
    assert again.stages[0].means == second.stages[0].means != first.stages[0].means
    assert answers(again, rows) == answers(second, rows)
    assert os.listdir(tmp_path) == ["bundle"]


def test_a_failed_save_leaves_the_old_model(spark, rows, tmp_path):
    path = str(tmp_path / "bundle")
    first = fitted(rows)
    save_model(first, path)
    broken = fitted(rows)
    broken.stages[1].set(broken.stages[1].lower, [object()])  # cannot be written, after the first stage was
    with pytest.raises(TypeError):
        save_model(broken, path, overwrite=True)
    assert answers(load_model(PipelineModel, path), rows) == answers(first, rows)
    assert os.listdir(tmp_path) == ["bundle"]


def test_overwrite_where_nothing_was(spark, rows, tmp_path):
    path = save_model(fitted(rows), str(tmp_path / "new"), overwrite=True)
    assert len(load_model(PipelineModel, path).stages) == 4


def test_columns_without_values(spark):
    rows = spark.createDataFrame([(None, None), (None, None)], "a double, b int")
    imputer = MeanImputer(["a", "b"]).fit(rows)
    assert imputer.means == {"a": None, "b": None}
    assert Winsorizer(["a"]).fit(rows).bounds == {"a": (None, None)}
    assert Winsorizer(["a"]).fit(rows).transform(imputer.transform(rows)).collect() == rows.collect()
