"""Model queries (rows-only checks): assembly, grid selection, evaluation, persistence,
importances and scoring. Each builds its own ``Workflow`` over the bound test tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderlens.operators import metrics as M
from orderlens.operators import train as TR
from orderlens.operators.encode import fit_formula
from orderlens.operators.features import NUMERIC_FEATURES
from orderlens.operators.linear import score_linear, slot_columns
from orderlens.operators.prep import TEST, TRAIN, VALIDATION
from orderlens.operators.score import merge_predictions, score
from orderlens.plans.catalog import scoring_columns
from orderlens.plans.params import DECIMALS, SCORE_END, SCORE_START, W_END, W_START
from orderlens.session import scratch_path
from orderlens.sources.binding import bind_tables, listing
from orderlens.sources.files import materialize, read_csv, save_model, write_csv
from orderlens.plans.workflow import ScoringBundle, Workflow, unseen


_MADE: dict = {}


def _once(spark, sf, name, make):
    """What the queries of one session share for one input, while its files stay the same: prepared
    tables, chosen models, saved bundles."""
    key, files = (spark.sparkContext.applicationId, sf.rstrip("/"), name), listing(spark, sf, "orders", "lineitem", "part")
    if key not in _MADE or _MADE[key][0] != files:
        _MADE[key] = (files, make())
    return _MADE[key][1]


def forget() -> None:
    """Drop all that is shared, so that the next query starts from its tables."""
    _MADE.clear()


def _wf(spark, sf) -> Workflow:
    return _once(spark, sf, "workflow", lambda: Workflow(spark, bind_tables(spark, sf), W_START, W_END))


def _binary(wf: Workflow, make, grid):
    train, val, test = wf.split(TRAIN), wf.split(VALIDATION), wf.split(TEST)
    sel = TR.select_best(make, grid, train, val, TR.binary_auc)
    # Both measures read the test rows' three numbers, which are scored once.
    scored = M.positive_probability(sel.model.transform(test)).select("label", "prediction", "p1").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        test_metrics = {"test_auc": M.auc(scored, score="p1").first()["auc"],
                        "test_accuracy": M.accuracy(scored).first()["accuracy"]}
    finally:
        scored.unpersist()
    return sel, test_metrics


def _multi(wf: Workflow, make, grid, metric, scaled=False):
    if scaled:
        parts = wf.scaled()
        train, val, test = parts[TRAIN], parts[VALIDATION], parts[TEST]
    else:
        train, val, test = wf.multiclass(TRAIN), wf.multiclass(VALIDATION), wf.multiclass(TEST)
    if make is TR.weighted_rf:
        train = TR.with_class_weights(train)
    sel = TR.select_best(make, grid, train, val, metric)
    test_metrics = {"test_auc": None, "test_accuracy": TR.multi_accuracy(sel.model, test)}
    return sel, test_metrics


#: All columns of the prepared table but its keys, the split, the raw score and the check columns.
FORMULA = "label ~ . - order_id - split - review_score - order_price - avg_product_photos_qty - n_product_items"


def assemble_features(spark, sf):
    """The vectors of the formula fitted on the training rows: their width, and each numeric feature read from its slot."""
    data = _wf(spark, sf).prepared.data
    out = fit_formula(data.where(F.col("split") == TRAIN), FORMULA).transform(data)
    slot = {name: i for i, name in M.slot_names(out)}
    v = vector_to_array("features")
    return out.select("order_id", "split", "label", F.size(v).cast("bigint").alias("n_slots"),
                      *[F.round(v[slot[c]] + (1e-9 if c == "avg_cust_value" else 0.0), DECIMALS).alias(c) for c in NUMERIC_FEATURES])


def train_rf_binary(spark, sf):
    sel, tm = _binary(_wf(spark, sf), TR.rf, TR.RF_GRID)
    return TR.trials_frame(spark, "rf_binary", sel, tm)


def train_lr_binary(spark, sf):
    sel, tm = _binary(_wf(spark, sf), TR.lr, TR.LR_BINARY_GRID)
    return TR.trials_frame(spark, "lr_binary", sel, tm)


def train_gbt_binary(spark, sf):
    sel, tm = _binary(_wf(spark, sf), TR.gbt, TR.GBT_GRID)
    return TR.trials_frame(spark, "gbt_binary", sel, tm)


def train_rf_multi(spark, sf):
    # the studied workflow selected this one on weighted F1 (its evaluator's default metric)
    sel, tm = _multi(_wf(spark, sf), TR.weighted_rf, TR.RF_GRID, TR.multi_f1)
    return TR.trials_frame(spark, "rf_multi", sel, tm)


def train_lr_multi(spark, sf):
    sel, tm = _multi(_wf(spark, sf), TR.lr, TR.LR_MULTI_GRID, TR.multi_accuracy)
    return TR.trials_frame(spark, "lr_multi", sel, tm)


def train_nb_multi(spark, sf):
    sel, tm = _multi(_wf(spark, sf), TR.nb, TR.NB_GRID, TR.multi_accuracy, scaled=True)
    return TR.trials_frame(spark, "nb_multi", sel, tm)


def model_leaderboard(spark, sf):
    """Chosen configuration of every model family, with its validation and test metrics."""
    wf = _wf(spark, sf)
    frames = []
    for name, make, grid in (("rf_binary", TR.rf, TR.RF_GRID), ("lr_binary", TR.lr, TR.LR_BINARY_GRID),
                             ("gbt_binary", TR.gbt, TR.GBT_GRID)):
        sel, tm = _binary(wf, make, grid)
        frames.append(TR.trials_frame(spark, name, sel, tm))
    for name, make, grid, metric, scaled in (("rf_multi", TR.weighted_rf, TR.RF_GRID, TR.multi_f1, False),
                                             ("lr_multi", TR.lr, TR.LR_MULTI_GRID, TR.multi_accuracy, False),
                                             ("nb_multi", TR.nb, TR.NB_GRID, TR.multi_accuracy, True)):
        sel, tm = _multi(wf, make, grid, metric, scaled)
        frames.append(TR.trials_frame(spark, name, sel, tm))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.where("chosen")


def _best_gbt(spark, sf):
    return _once(spark, sf, "gbt", lambda: _binary(_wf(spark, sf), TR.gbt, TR.GBT_GRID)[0].model)


def _best_lr_multi(spark, sf):
    return _once(spark, sf, "lr_multi", lambda: _multi(_wf(spark, sf), TR.lr, TR.LR_MULTI_GRID, TR.multi_accuracy)[0].model)


def _saved(spark, sf, name, model) -> str:
    """Path of the saved bundle of a chosen model."""
    def make():
        return _wf(spark, sf).bundle(model()).save(scratch_path(spark, f"bundle-{name}"))
    return _once(spark, sf, f"bundle-{name}", make)


def scoring_features(spark, sf):
    """Numeric features of the unseen window's orders, from a loaded bundle and these orders' tables alone."""
    bundle = ScoringBundle.load(_saved(spark, sf, "gbt", lambda: _best_gbt(spark, sf)))
    return scoring_columns(bundle.prepare(unseen(bind_tables(spark, sf), SCORE_START, SCORE_END)))


def _measures(model, test):
    """AUC of a binary model, accuracy of another."""
    if model.numClasses == 2:
        return TR.binary_auc(model, test)
    return TR.multi_accuracy(model, test)


def model_roundtrip(spark, sf):
    """Save a model of each family as a bundle, load it, and compare its predictions and its metric on the test split."""
    wf = _wf(spark, sf)
    train, multi = wf.split(TRAIN), wf.multiclass(TRAIN)
    binary_test, multi_test = wf.split(TEST), wf.multiclass(TEST)
    models = {"gbt_binary": _best_gbt(spark, sf), "lr_binary": TR.lr(TR.LR_BINARY_GRID[0]).fit(train),
              "lr_multi": _best_lr_multi(spark, sf), "rf_multi": TR.rf({"numTrees": 10, "maxDepth": 5}).fit(multi)}
    out = None
    for name, model in models.items():
        again = ScoringBundle.load(wf.bundle(model).save(scratch_path(spark, f"bundle-{name}"))).model
        test = binary_test if model.numClasses == 2 else multi_test
        both = score(model, test, with_probability=False).withColumnRenamed("prediction", "before").distinct().join(
            score(again, test, with_probability=False).withColumnRenamed("prediction", "after").distinct(), "order_id")
        row = both.agg(F.lit(name).alias("model"), F.coalesce(F.bool_and(F.col("before") == F.col("after")), F.lit(False)).alias("same"),
                       F.lit(_measures(model, test) == _measures(again, test)).alias("same_metric"))
        out = row if out is None else out.unionByName(row)
    return out


def model_params(spark, sf):
    """Parameters of the reloaded GBT and of the reloaded five-class LR."""
    out = None
    for name, model in (("gbt", _best_gbt), ("lr_multi", _best_lr_multi)):
        loaded = ScoringBundle.load(_saved(spark, sf, name, lambda: model(spark, sf))).model
        frame = TR.param_frame(spark, loaded).select(F.lit(name).alias("model"), "param", "value")
        out = frame if out is None else out.unionByName(frame)
    return out


def feature_importance(spark, sf):
    """Top-10 slots of the GBT (from the nodes of the saved trees) and of the multiclass LR (|mean coef|)."""
    slots = M.slot_names(_wf(spark, sf).assembled())
    names = spark.createDataFrame(slots, "slot int, feature string")  # a row per model input
    nodes = spark.read.parquet(save_model(_best_gbt(spark, sf), scratch_path(spark, "gbt-nodes")) + "/data")
    found = names.join(F.broadcast(M.node_importances(nodes)), "slot", "left").select("feature", F.coalesce("score", F.lit(0.0)).alias("score"))
    top_gbt = found.orderBy(F.col("score").desc(), "feature").limit(10)
    top_lr = M.feature_importance(spark, M.multiclass_coef_importance(_best_lr_multi(spark, sf).coefficientMatrix), slots)
    return (top_gbt.select(F.lit("gbt_binary").alias("model"), "feature", "score")
            .unionByName(top_lr.select(F.lit("lr_multi").alias("model"), "feature", "score")))


def linear_scoring(spark, sf):
    """Every order of the unseen window scored by the loaded five-class LR, as column expressions and by the model itself."""
    bundle = ScoringBundle.load(_saved(spark, sf, "lr_multi", lambda: _best_lr_multi(spark, sf)))
    rows = materialize(bundle.prepare(unseen(bind_tables(spark, sf), SCORE_START, SCORE_END)), "unseen")
    ours = score_linear(bundle.model, slot_columns(bundle.feature_model), rows)
    model = score(bundle.model, bundle.feature_model.transform(rows), with_probability=False).withColumnRenamed("prediction", "by_model")
    return ours.join(model, "order_id").select("order_id", (F.col("prediction") == F.col("by_model")).alias("same"),
                                               F.col("prediction").between(1, 5).alias("is_score"))


def _scored(spark, sf, name, model, **kw):
    bundle = ScoringBundle.load(_saved(spark, sf, name, lambda: model(spark, sf)))
    return score(bundle.model, bundle.features(unseen(bind_tables(spark, sf), SCORE_START, SCORE_END)), **kw)


def score_orders(spark, sf):
    """Score the unseen window's tables with the loaded GBT bundle, write the result as CSV and read it back."""
    path = scratch_path(spark, "result_csv")
    write_csv(_scored(spark, sf, "gbt", _best_gbt), path)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("prediction", T.DoubleType()),
                           T.StructField("p1", T.DoubleType())])
    return read_csv(spark, path, schema)


def merge_scored(spark, sf):
    """Binary GBT and five-class LR predictions of the unseen window's tables, merged by order."""
    return merge_predictions(_scored(spark, sf, "gbt", _best_gbt), _scored(spark, sf, "lr_multi", _best_lr_multi, with_probability=False))


MODEL_QUERIES = {
    "assemble_features": assemble_features,
    "train_rf_binary": train_rf_binary,
    "train_lr_binary": train_lr_binary,
    "train_gbt_binary": train_gbt_binary,
    "train_rf_multi": train_rf_multi,
    "train_lr_multi": train_lr_multi,
    "train_nb_multi": train_nb_multi,
    "model_leaderboard": model_leaderboard,
    "scoring_features": scoring_features,
    "model_roundtrip": model_roundtrip,
    "model_params": model_params,
    "feature_importance": feature_importance,
    "score_orders": score_orders,
    "merge_scored": merge_scored,
    "linear_scoring": linear_scoring,
}
