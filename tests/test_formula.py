"""Formula terms against a schema, formula slots against the explicit pipeline, multi-hot columns, Naive Bayes labels."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from orderlens.operators import encode, train as TR
from orderlens.operators.features import FEATURE_COLUMNS
from orderlens.operators.prep import TRAIN, only
from orderlens.plans.modelling import FORMULA
from orderlens.plans.params import W_END, W_START
from orderlens.plans.workflow import Workflow
from orderlens.sources.binding import bind_tables
from tests.conftest import SF


@pytest.mark.parametrize("formula, terms", [
    ("y ~ .", ["a", "b", "c"]), ("y ~ . -a", ["b", "c"]), ("y~.-a - c", ["b"]), ("y ~ c + a", ["c", "a"]), ("y ~ . - b + b", ["a", "c", "b"]),
    ("b ~ y + a - a", ["y"])])
def test_terms(formula, terms):
    assert encode.formula_terms(formula, ["a", "y", "b", "c"])[1] == terms


def test_unknown_terms_are_refused():
    with pytest.raises(ValueError, match="nope"):
        encode.formula_terms("y ~ . - nope", ["a", "y"])


def test_formula_and_explicit_pipeline_give_equal_slots(spark):
    wf = Workflow(spark, bind_tables(spark, SF), W_START, W_END)
    data = wf.prepared.data
    assert encode.formula_terms(FORMULA, data.columns) == ("label", FEATURE_COLUMNS)
    formula = encode.fit_features(only(data, TRAIN), FORMULA)
    # a status not seen in training is the zero vector in both
    some = data.selectExpr("* except (order_status)", "if(order_id % 5 = 0, 'new', order_status) as order_status").select(data.columns)
    def vectors(model):
        return {(r["order_id"], r["review_score"]): r["v"] for r in model.transform(some).select("order_id", "review_score", vector_to_array("features").alias("v")).collect()}
    a, b = vectors(formula), vectors(wf.feature_model)
    assert a.keys() == b.keys() and all(np.array_equal(a[k], b[k]) for k in a)


def test_multihot_columns(spark):
    rows = spark.createDataFrame([(1, ["b", "a"]), (2, ["c"]), (3, None), (4, [])], "order_id long, payment_types array<string>")
    out = encode.multihot_columns(rows)
    assert out.columns == ["order_id", "payment_a", "payment_b", "payment_c"]
    assert sorted(map(tuple, out.collect())) == [(1, 1, 1, 0), (2, 0, 0, 1), (4, 0, 0, 0)]


def test_naive_bayes_answers_with_labels(spark):
    rows = [(1.0, [9.0, 0.0, 0.0]), (1.0, [8.0, 0.0, 1.0]), (3.0, [0.0, 9.0, 0.0]), (3.0, [0.0, 8.0, 0.0]), (5.0, [0.0, 0.0, 9.0])]
    df = spark.createDataFrame([(y, Vectors.dense(x)) for y, x in rows], ["label", "scaled_features"])
    model = TR.nb({"smoothing": 1.0}).fit(df)
    assert TR.multi_accuracy(model, df) == 1.0
    without_labels = model.transform(df.drop("label"))
    assert {r["prediction"] for r in without_labels.collect()} == {1.0, 3.0, 5.0}
