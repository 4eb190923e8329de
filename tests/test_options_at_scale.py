"""Bucketed tables, sketches, node importances, linear scoring, the concurrent grid."""

import duckdb
import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from orderlens.operators import metrics as M
from orderlens.operators import reviews, sketches
from orderlens.operators import train as TR
from orderlens.operators.features import order_features
from orderlens.operators.linear import score_linear, slot_columns
from orderlens.operators.prep import TRAIN, Winsorizer
from orderlens.operators.score import score
from orderlens.plans.params import W_END, W_START
from orderlens.plans.workflow import Workflow
from orderlens.sources.binding import bind_tables
from orderlens.sources.bucketed import bucket_by_order
from orderlens.sources.files import save_model
from tests.conftest import SF


@pytest.fixture(scope="module")
def workflow(spark):
    return Workflow(spark, bind_tables(spark, SF), W_START, W_END)


def test_bucketed_tables_join_and_group_by_order_without_a_shuffle(spark):
    plain = bind_tables(spark, SF)
    features = order_features(bucket_by_order(plain, 8), write_payments=False)
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(order_id" not in plan and "hashpartitioning(customer_id" in plan
    assert "hashpartitioning(order_id" in order_features(plain, write_payments=False)._jdf.queryExecution().executedPlan().toString()
    def rows(df):
        return sorted(tuple(round(x + 1e-9, 6) if isinstance(x, float) else str(x) for x in r) for r in df.collect())
    assert rows(features) == rows(order_features(plain))


def test_merged_month_sketches_keep_the_rank_error(spark):
    n = 50_000
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("x"), (F.col("id") % 12).alias("month"),
                               F.lit(None).cast("double").alias("void"), (F.col("id") % 3).alias("few"))
    kept = sketches.quantile_sketches(df, ["x", "void", "few"], ["month"])
    assert kept.count() == 12
    got = sketches.merged_quantiles(kept, ["x", "void", "few"], [0.01, 0.5, 0.99])
    assert all(abs(v / n - p) <= sketches.RANK_ERROR for v, p in zip(got["x"], [0.01, 0.5, 0.99]))
    assert got["void"] == [None] * 3 and got["few"] == [0.0, 1.0, 2.0]
    half = sketches.merged_quantiles(kept.where("month < 6"), ["x"], [0.5])["x"][0]
    exact = df.where("month < 6").agg(F.percentile("x", 0.5)).first()[0]
    assert abs(half - exact) / n <= 2 * sketches.RANK_ERROR
    bounds = Winsorizer(["x"], method="sketch", group=["month"]).fit(df).bounds["x"]
    assert all(df.agg(sketches.rank_within("x", v, p)).first()[0] for v, p in zip(bounds, (0.01, 0.99)))


def test_distinct_sketches_keep_their_error_and_merge(spark):
    df = spark.range(200_000).select((F.col("id") % 60_000).alias("x"), (F.col("id") % 4).alias("g"))
    kept = sketches.distinct_sketches(df, ["x"], ["g"])
    whole = sketches.distinct_estimates(kept, ["x"]).first()["x"]
    assert abs(whole - 60_000) <= 4 * sketches.COUNT_ERROR * 60_000
    t = bind_tables(spark, SF).reviews
    plan = reviews.review_cardinality(t, approx=True)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def _nodes(spark, model, tmp_path):
    return str(save_model(model, str(tmp_path / "model"))) + "/data"


@pytest.fixture(scope="module")
def points(spark):
    df = spark.range(600).selectExpr("cast(id % 7 as double) a", "cast(id % 13 as double) b", "cast(id % 5 as double) c",
                                     "cast((id % 7 > 3 and id % 13 < 9) or id % 5 = 0 as double) label", "1.0 + id % 3 as w")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


@pytest.mark.parametrize("kind", ["gbt", "forest", "weighted forest"])
def test_importances_from_saved_nodes(spark, points, tmp_path, kind):
    forest = kind != "gbt"
    maker = RandomForestClassifier(numTrees=7, maxDepth=4, seed=3) if forest else TR.gbt({"maxDepth": 3, "maxIter": 4})
    model = (maker.setWeightCol("w") if kind.startswith("weighted") else maker).fit(points)
    path = _nodes(spark, model, tmp_path)
    got = {r["slot"]: r["score"] for r in M.node_importances(spark.read.parquet(path), per_tree=forest, gini=forest).collect()}
    assert np.allclose([got.get(i, 0.0) for i in range(3)], model.featureImportances.toArray())
    weight = "list_sum(nodeData.impurityStats)" if forest else "nodeData.impurityStats[1]"
    share = "gain / sum(gain) over (partition by tree)" if forest else "gain"
    sql = f"""with g as (select treeID as tree, nodeData.split.featureIndex as slot, sum(nodeData.gain * {weight}) as gain
                         from read_parquet('{path}/*.parquet') where nodeData.split.featureIndex >= 0 group by all),
              s as (select slot, {share} as share from g)
              select slot, sum(share) / (select sum(share) from s) from s group by slot"""
    assert {k: pytest.approx(v) for k, v in duckdb.sql(sql).fetchall()} == got


@pytest.mark.parametrize("classes", [2, 5])
def test_linear_scoring_equals_the_model(spark, workflow, classes):
    train = workflow.split(TRAIN) if classes == 2 else workflow.multiclass(TRAIN)
    model = TR.lr({"maxIter": 8, "regParam": 0.01}).fit(train)
    rows = workflow.prepared.data.selectExpr("* except (order_status)", "if(order_id % 5 = 0, 'new', order_status) as order_status")
    ours = score_linear(model, slot_columns(workflow.feature_model), rows, ["order_id", "review_score"])
    theirs = score(model, workflow.feature_model.transform(rows), ["order_id", "review_score"], with_probability=classes == 2)
    key = ["order_id", "review_score"]
    both = ours.join(theirs.withColumnsRenamed({"prediction": "theirs", "p1": "q1"}), key)
    assert both.count() == rows.count() and both.where("prediction <> theirs").count() == 0
    if classes == 2:
        assert both.agg(F.max(F.abs(F.col("p1") - F.col("q1")))).first()[0] < 1e-9


def test_concurrent_grid_chooses_as_one_by_one(points):
    train, val = points.where("a < 5"), points
    grid = [{"maxIter": 1, "regParam": 0.5}, {"maxIter": 20, "regParam": 0.0}, {"maxIter": 20, "regParam": 0.0, "tol": 1e-6}]
    both = [TR.select_best(TR.lr, grid, train, val, TR.binary_auc, parallel=n) for n in (1, 3)]
    assert both[0].trials == both[1].trials and both[0].params == both[1].params


def test_the_first_of_equal_points_wins(points):
    grid = [{"maxIter": k} for k in (5, 3, 4, 2)]
    seen = TR.select_best(TR.lr, grid, points, points, lambda model, df: 0.5, parallel=4)
    assert seen.params == {"maxIter": 5} and [p for p, _ in seen.trials] == grid
    undefined = TR.select_best(TR.lr, grid[:2], points, points, lambda model, df: None)
    assert undefined.model is None


def test_a_fitted_binary_model_scores_after_an_observation(spark, points):
    from pyspark.sql import Observation
    seen = Observation("rows")
    assert spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).count() == 5 and seen.get["n"] == 5
    model = TR.lr({"maxIter": 5}).fit(points)
    assert not model.hasSummary and TR.binary_auc(model, points) > 0.5


@pytest.mark.parametrize("make", [TR.rf, TR.weighted_rf])
def test_a_fitted_forest_scores_after_an_observation(spark, points, make):
    from pyspark.sql import Observation
    seen = Observation("rows")
    assert spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).count() == 5 and seen.get["n"] == 5
    train = TR.with_class_weights(points) if make is TR.weighted_rf else points
    model = make({"numTrees": 3, "maxDepth": 3}).fit(train)
    assert not model.hasSummary and TR.binary_auc(model, points) > 0.5
