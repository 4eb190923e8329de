"""Batch scoring and merging of binary and multiclass predictions (M17-M19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.metrics import positive_probability


def score(model, features: DataFrame, keep=("order_id",), with_probability: bool = True) -> DataFrame:
    out = model.transform(features)
    cols = [*keep, "prediction"]
    if with_probability and "probability" in out.columns:
        out = positive_probability(out)
        cols.append("p1")
    return out.select(*cols)


def merge_predictions(binary: DataFrame, multiclass: DataFrame, key: str = "order_id") -> DataFrame:
    """Every binary prediction, with the multiclass one where present (left join)."""
    b = binary.select(key, F.col("prediction").alias("binary_prediction"))
    m = multiclass.select(key, F.col("prediction").alias("multiclass_prediction"))
    return b.join(m, key, "left")
