"""Model training and selection on a fixed validation split (M1-M7, M11, M12).

``select_best`` fits the grid points on train side by side, scores validation, and keeps the
first strictly better model. The assembled train / validation frames are persisted for the
iterative fits and released afterwards.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.operators import metrics as M

# Hyper-parameter grids of the studied workflow (fixed values).
RF_GRID = [{"numTrees": 150, "maxDepth": 10}, {"numTrees": 150, "maxDepth": 15}, {"numTrees": 200, "maxDepth": 20}]
LR_BINARY_GRID = [{"regParam": 0.1, "maxIter": 50}, {"regParam": 0.01, "maxIter": 100}, {"regParam": 0.1, "maxIter": 150}]
GBT_GRID = [{"maxDepth": 3, "maxIter": 10}]
LR_MULTI_GRID = [{"regParam": 0.01, "maxIter": 50}, {"regParam": 0.01, "maxIter": 100}, {"regParam": 0.1, "maxIter": 100}]
NB_GRID = [{"smoothing": 0.5, "modelType": "multinomial"}, {"smoothing": 1.0, "modelType": "multinomial"},
           {"smoothing": 1.5, "modelType": "multinomial"}]

SEED = 121  # fixed value of the studied workflow

# Execution settings for tree ensembles (no effect on the fitted trees): a larger node
# batch per pass and cached node ids cut the number of passes over the data for deep trees.
TREE_EXEC = {"maxMemoryInMB": 1024, "cacheNodeIds": True}

#: Rows of a partition that a forest is grown on. Every partition sends a histogram for every node
#: of every tree, though it may hold no row of it, so many small ones multiply the work of deep trees.
FOREST_ROWS = 20_000
#: Each task of a forest holds the histograms of a batch of nodes, and a grid's forests grow side by side.
FOREST_EXEC = {**TREE_EXEC, "maxMemoryInMB": 256}


WEIGHT = "class_weight"


def with_class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``df`` with the inverse frequency of each row's class (mean 1 over the rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    every = Window.partitionBy(F.lit(0))  # over a row per class
    weight = F.sum("__n").over(every) / (F.count(F.lit(1)).over(every) * F.col("__n"))
    weights = counts.select(label, weight.alias(WEIGHT))
    return df.join(F.broadcast(weights), label)  # a row per class


def _without_summary(model, dataset: DataFrame):
    """``model`` without its training summary.

    A binary summary holds the session, which scoring then ships to the tasks with the model; once
    the session has seen an ``Observation`` it cannot be serialised, and scoring with the fitted
    model would fail. The summary repeats measures that are taken here anyway."""
    model._java_obj.setSummary(dataset.sparkSession._jvm.scala.Option.empty())
    return model


def in_forest_partitions(rows: DataFrame, size: int = FOREST_ROWS) -> DataFrame:
    """``rows`` in no more partitions than one for each ``size`` rows, all of them kept."""
    return rows.coalesce(max(1, -(-rows.count() // size)))


class PlainRandomForestClassifier(RandomForestClassifier):
    """Random forest whose model keeps no training summary, grown on ``in_forest_partitions``."""

    def _fit(self, dataset: DataFrame):
        return _without_summary(super()._fit(in_forest_partitions(dataset)), dataset)


def rf(params, features="features"):
    return PlainRandomForestClassifier(featuresCol=features, labelCol="label", seed=SEED, **FOREST_EXEC, **params)


def weighted_rf(params, features="features"):
    """The forest on rows ``with_class_weights``."""
    return rf(params, features).setWeightCol(WEIGHT)


class PlainLogisticRegression(LogisticRegression):
    """Logistic regression whose model keeps no training summary."""

    def _fit(self, dataset: DataFrame):
        return _without_summary(super()._fit(dataset), dataset)


def lr(params, features="features"):
    return PlainLogisticRegression(featuresCol=features, labelCol="label", **params)


def gbt(params, features="features"):
    return GBTClassifier(featuresCol=features, labelCol="label", seed=SEED, **TREE_EXEC, **params)


class ClassNaiveBayes:
    """Naive Bayes on any numeric labels.

    MLlib's model answers with the place of the class among the classes seen in training, which
    is the label only where labels run from 0 without a gap; scores of 1 to 5 would all be one
    too low. Labels are indexed for the fit and its answers turned back into labels."""

    def __init__(self, params: dict, features: str = "scaled_features"):
        self.params, self.features = params, features

    def fit(self, train: DataFrame) -> PipelineModel:
        classes = sorted(r[0] for r in train.select(F.col("label").cast("double")).distinct().collect())  # a row per class
        table = "array(" + ", ".join(f"{c!r}D" for c in classes) + ")"
        to_index = SQLTransformer(statement=f"SELECT *, CAST(array_position({table}, CAST(label AS DOUBLE)) - 1 AS DOUBLE) AS class_no FROM __THIS__")
        model = NaiveBayes(featuresCol=self.features, labelCol="class_no", predictionCol="predicted_no", **self.params).fit(to_index.transform(train))
        to_label = SQLTransformer(statement=f"SELECT *, element_at({table}, CAST(predicted_no AS INT) + 1) AS prediction FROM __THIS__")
        return PipelineModel(stages=[model, to_label])


def nb(params, features="scaled_features"):
    return ClassNaiveBayes(params, features)


def binary_auc(model, df: DataFrame) -> float:
    scored = M.positive_probability(model.transform(df))
    return M.auc(scored, score="p1").first()["auc"]


def multi_accuracy(model, df: DataFrame) -> float:
    return M.accuracy(model.transform(df)).first()["accuracy"]


def multi_f1(model, df: DataFrame) -> float:
    return M.weighted_f1(model.transform(df)).first()["weighted_f1"]


@dataclass
class Selection:
    model: object
    params: dict
    metric: float
    trials: list = field(default_factory=list)  # (params, metric) per grid point


#: Grid points that are fitted side by side.
PARALLEL = 3


def select_best(make: Callable, grid: Sequence[dict], train: DataFrame, val: DataFrame,
                metric: Callable, persist: bool = True, parallel: int = PARALLEL) -> Selection:
    """Fit every grid point and keep the first strictly better one, in the order of the grid.

    Up to ``parallel`` points are fitted and measured side by side on the one persisted frame, each
    in a thread with a scheduler pool of its own (fair sharing where the cluster configures it);
    which one is chosen does not depend on which is done first."""
    if persist:
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
        val = val.persist(StorageLevel.MEMORY_AND_DISK)
    spark = train.sparkSession

    def trial(p: dict):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", "grid-" + "-".join(str(v) for v in p.values()))
        model = make(p).fit(train)
        return model, metric(model, val)
    best = Selection(None, {}, float("-inf"))
    try:
        if persist and parallel > 1 and len(grid) > 1:
            train.count()  # filled once, not by every point at a time
            val.count()
        with ThreadPoolExecutor(max(1, min(parallel, len(grid)))) as pool:
            done = [pool.submit(inheritable_thread_target(spark)(trial), p) for p in grid]
            for p, result in zip(grid, done):
                model, m = result.result()
                best.trials.append((p, m))
                if m is not None and m > best.metric:
                    best.model, best.params, best.metric = model, p, m
    finally:
        if persist:
            train.unpersist()
            val.unpersist()
    return best


def trials_frame(spark, name: str, sel: Selection, test_metrics: dict) -> DataFrame:
    """One row per grid point: model, params, validation metric, chosen flag, test metrics of the chosen one."""
    rows = []
    for p, m in sel.trials:
        chosen = p == sel.params
        rows.append((name, ",".join(f"{k}={v}" for k, v in sorted(p.items())), float(m) if m is not None else None,
                     chosen, *(float(test_metrics[k]) if chosen and test_metrics.get(k) is not None else None
                               for k in ("test_auc", "test_accuracy"))))
    return spark.createDataFrame(rows, "model string, params string, val_metric double, chosen boolean, "
                                       "test_auc double, test_accuracy double")


def param_frame(spark, model) -> DataFrame:
    pm = model.extractParamMap()
    rows = sorted((p.name, str(v)) for p, v in pm.items())
    return spark.createDataFrame(rows, "param string, value string")
