"""Classifier metrics as DataFrame operators (no driver-side loops over rows).

Inputs are scored rows with ``label``, ``prediction`` and a class-1 score. ROC and AUC
group by distinct score first (partially combined, so ties and hot scores collapse
map-side) and write the counts, then take running totals in descending score order over
ranges of about ``block_rows`` distinct scores (``orderlens.operators.ranges``). No window
ever sees all thresholds in one task.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.columns import safe_ratio
from orderlens.operators.ranges import in_ranges, running_totals
from orderlens.sources.files import materialize


def positive_probability(df: DataFrame, col: str = "probability", out: str = "p1") -> DataFrame:
    """P(class 1) from an MLlib probability vector."""
    return df.withColumn(out, vector_to_array(F.col(col))[1])


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, classes: Optional[Sequence[float]] = None, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """label x prediction counts, one ``pred_<class>`` column per class, missing cells 0."""
    classes = list(classes) if classes is not None else [0.0, 1.0]
    piv = df.groupBy(label).pivot(prediction, classes).count().na.fill(0)
    return piv.select(label, *[F.col(f"`{piv.columns[i + 1]}`").cast("bigint").alias(f"pred_{int(c)}")
                               for i, c in enumerate(classes)])


def weighted_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """F1 per true class weighted by class frequency (MLlib's ``f1`` metric); a class
    never predicted has precision 0."""
    cm = confusion_counts(df, label, prediction)
    per_label = cm.groupBy(F.col(label).alias("cls")).agg(
        F.sum("n").alias("n_l"), F.sum(F.when(F.col(label) == F.col(prediction), F.col("n"))).alias("tp"))
    per_pred = cm.groupBy(F.col(prediction).alias("cls")).agg(F.sum("n").alias("n_p"))
    j = per_label.join(per_pred, "cls", "left")
    tp = F.coalesce(F.col("tp"), F.lit(0)).cast("double")
    p = F.coalesce(safe_ratio(tp, F.col("n_p").cast("double")), F.lit(0.0))
    r = tp / F.col("n_l").cast("double")
    f1 = F.coalesce(safe_ratio(2 * p * r, p + r), F.lit(0.0))
    return j.agg((F.sum(F.col("n_l") * f1) / F.sum("n_l")).alias("weighted_f1"))


def _score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """pos and neg rows of each distinct score, written: the rows are scored once for all that
    follows. Rows without a label or a score say nothing and are left out."""
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    counts = known.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.when(F.col(label) == 1.0, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(label) == 1.0, 0).otherwise(1)).cast("bigint").alias("neg"))
    return materialize(counts, "score-counts")


def _running_desc(counts: DataFrame, block_rows: int = 100_000) -> DataFrame:
    """Add cum_pos / cum_neg: totals over thresholds >= this one (descending order)."""
    order = [F.col("threshold").desc()]
    return running_totals(in_ranges(counts, order, block_rows), ["pos", "neg"], order)


def roc_curve(df: DataFrame, label: str = "label", score: str = "probability", block_rows: int = 100_000) -> DataFrame:
    """One ROC point per distinct score: threshold, tpr, fpr (ties collapsed). With a
    single class present the undefined rate is null. Rows without a label or score are out."""
    counts = _score_counts(df, label, score)
    run = _running_desc(counts, block_rows)
    tot = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    P, N = float(tot["P"] or 0), float(tot["N"] or 0)
    return run.select(
        "threshold",
        safe_ratio(F.col("cum_pos").cast("double"), F.lit(P)).alias("tpr"),
        safe_ratio(F.col("cum_neg").cast("double"), F.lit(N)).alias("fpr"))


def auc(df: DataFrame, label: str = "label", score: str = "probability", block_rows: int = 100_000) -> DataFrame:
    """Exact area under the ROC curve (trapezoids over distinct scores; equals the
    Mann-Whitney statistic with ties counted half). Null with a single class. Rows without
    a label or score are out."""
    run = _running_desc(_score_counts(df, label, score), block_rows)
    pos_above = F.col("cum_pos") - F.col("pos")
    area = F.col("neg").cast("double") * (pos_above.cast("double") + F.col("pos").cast("double") / 2.0)
    return run.agg(safe_ratio(F.sum(area), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))


def slot_names(df: DataFrame, features_col: str = "features") -> list[tuple[int, str]]:
    """(index, name) of every slot of an assembled vector, from its ML attribute metadata."""
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    out = []
    for group in attrs.values():
        out += [(a["idx"], a.get("name", f"f{a['idx']}")) for a in group]
    if not out and "num_attrs" in meta:
        out = [(i, f"f{i}") for i in range(meta["num_attrs"])]
    return sorted(out)


def feature_importance(spark, scores: Sequence[float], names: Sequence[tuple[int, str]], top: int = 10) -> DataFrame:
    """(feature, score) for the ``top`` slots. Input is one number per model slot (bounded
    by the model width), so building it on the driver is bounded."""
    rows = [(name, float(scores[idx])) for idx, name in names if idx < len(scores)]
    df = spark.createDataFrame(rows, "feature string, score double")
    return df.orderBy(F.col("score").desc(), F.col("feature")).limit(top)


def node_importances(nodes: DataFrame, per_tree: bool = False, gini: bool = False) -> DataFrame:
    """(slot, score) from the node table of a saved tree ensemble: each split's gain times the weight
    of the rows it saw, summed per slot, in all 1. ``per_tree`` weighs trees alike (forests do,
    boosted trees do not); the rows' weight is the first impurity statistic of a regression tree
    and the sum of them where they are counts per class (``gini``)."""
    node = nodes.select(F.col("treeID").alias("tree"), "nodeData.*").where(F.col("split.featureIndex") >= 0)
    weight = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x) if gini else F.get("impurityStats", F.lit(0))
    gains = node.groupBy("tree", F.col("split.featureIndex").alias("slot")).agg(F.sum(F.col("gain") * weight).alias("gain"))
    if per_tree:
        whole = gains.groupBy("tree").agg(F.sum("gain").alias("whole"))
        gains = gains.join(whole, "tree").withColumn("gain", safe_ratio(F.col("gain"), F.col("whole")))
    slots = gains.groupBy("slot").agg(F.sum("gain").alias("gain"))
    every = Window.partitionBy(F.lit(0))  # over a row per slot of the model
    return slots.select("slot", safe_ratio(F.col("gain"), F.sum("gain").over(every)).alias("score"))


def multiclass_coef_importance(coef_matrix, mode: str = "abs_of_mean"):
    """Per-slot importance of a multinomial LR: |mean over classes of coef| (the studied
    workflow; opposite signs cancel) or mean over classes of |coef|."""
    import numpy as np
    m = coef_matrix.toArray()
    return (np.abs(m.mean(axis=0)) if mode == "abs_of_mean" else np.abs(m).mean(axis=0)).tolist()
