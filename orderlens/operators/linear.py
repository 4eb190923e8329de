"""Linear models as column expressions (M17): a loaded logistic regression scores prepared rows
inside generated code, without assembling vectors."""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.encode import PAYMENT_VEC, STATUS_VEC


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def slot_columns(feature_model: PipelineModel) -> list[Column]:
    """One expression per slot of the assembled vector, in slot order: numbers as they are, 0/1 for
    each status and each payment type that the pipeline was fitted on."""
    def stage(kind):
        return next(s for s in feature_model.stages if isinstance(s, kind))
    statuses = stage(StringIndexerModel).labels
    n_status = stage(OneHotEncoderModel).categorySizes[0] + (stage(StringIndexerModel).getHandleInvalid() == "keep") - 1  # the last level is all zeros
    out = []
    for name in stage(VectorAssembler).getInputCols():
        if name == STATUS_VEC:
            out += [_flag(F.col("order_status") == F.lit(s)) for s in statuses[:n_status]]
        elif name == PAYMENT_VEC:
            out += [_flag(F.array_contains("payment_types", t)) for t in stage(CountVectorizerModel).vocabulary]
        else:
            out.append(F.col(name).cast("double"))
    return out


def margin(slots: Sequence[Column], weights: Sequence[float], intercept: float) -> Column:
    terms = [x * F.lit(float(w)) for x, w in zip(slots, weights, strict=True) if w]
    return reduce(add, terms, F.lit(float(intercept)))


def score_linear(model, slots: Sequence[Column], rows: DataFrame, keep: Sequence[str] = ("order_id",)) -> DataFrame:
    """``keep`` and the prediction (and ``p1`` of a binary model) of a ``LogisticRegressionModel``. Of
    equal margins the first class wins, as in the model itself."""
    if model.numClasses == 2 and model.coefficientMatrix.numRows == 1:
        p1 = 1 / (1 + F.exp(-margin(slots, model.coefficients.toArray(), model.intercept)))
        out = rows.withColumn("p1", p1)
        return out.select(*keep, (F.col("p1") > F.lit(model.getThreshold())).cast("double").alias("prediction"), "p1")
    margins = F.array(*[margin(slots, w, b) for w, b in zip(model.coefficientMatrix.toArray(), model.interceptVector.toArray())])
    out = rows.withColumn("margins", margins)
    return out.select(*keep, (F.array_position("margins", F.array_max("margins")) - 1).cast("double").alias("prediction"))
