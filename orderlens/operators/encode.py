"""Model inputs: one pipeline fitted once on training rows and reused for validation, test and
scoring, either with its stages written out (status one-hot, payment-type multi-hot, assembler)
or from an R formula whose terms are resolved against the table. Both give the same slots."""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import CountVectorizer, HashingTF, OneHotEncoder, RFormula, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.features import FEATURE_COLUMNS

STATUS_VEC = "orderstatusInd2"
PAYMENT_VEC = "payment_types_dummy"


def assembler_inputs(columns: Sequence[str] = FEATURE_COLUMNS) -> list[str]:
    rename = {"order_status": STATUS_VEC, "payment_types": PAYMENT_VEC}
    return [rename.get(c, c) for c in columns]


def status_encoder(handle_invalid: str = "keep") -> list:
    """Alphabetical index then one-hot with the last level dropped (it is the all-zero vector).
    With ``keep`` that level stands for a status not seen in training."""
    return [StringIndexer(inputCol="order_status", outputCol="orderstatusInd", stringOrderType="alphabetAsc",
                          handleInvalid=handle_invalid),
            OneHotEncoder(inputCol="orderstatusInd", outputCol=STATUS_VEC, dropLast=True)]


def payment_encoder(encoding: str = "vocabulary", num_features: int = 1 << 18):
    """Multi-hot of the payment-type set. ``vocabulary`` gives one named slot per type seen
    in training, however many (the vocabulary has no cap); ``hash`` is a ``HashingTF`` of ``num_features`` slots (2^18 by default,
    the width the studied workflow used)."""
    if encoding == "hash":
        return HashingTF(inputCol="payment_types", outputCol=PAYMENT_VEC, numFeatures=num_features, binary=True)
    return CountVectorizer(inputCol="payment_types", outputCol=PAYMENT_VEC, binary=True, minDF=1.0, vocabSize=2 ** 31 - 1)


def feature_pipeline(columns: Sequence[str] = FEATURE_COLUMNS, payment_encoding: str = "vocabulary",
                     num_features: int = 1 << 18, status_invalid: str = "keep") -> Pipeline:
    return Pipeline(stages=status_encoder(status_invalid) + [
        payment_encoder(payment_encoding, num_features),
        VectorAssembler(inputCols=assembler_inputs(columns), outputCol="features", handleInvalid="error"),
    ])


def formula_terms(formula: str, columns: Sequence[str]) -> tuple[str, list[str]]:
    """(label, terms) of ``label ~ . - a + b``: ``.`` stands for all columns but the label, terms
    after a minus go, and the rest keep the order in which they came. A term that is no column is an error."""
    label, _, right = (x.strip() for x in formula.partition("~"))
    terms: list[str] = []
    for sign, name in re.findall(r"([+-]?)\s*([^\s+-]+)", right):
        named = [c for c in columns if c != label] if name == "." else [name]
        unknown = [c for c in (label, *named) if c not in columns]
        if unknown:
            raise ValueError(f"no such column: {', '.join(unknown)}")
        if sign == "-":
            terms = [t for t in terms if t not in named]
        else:
            terms += [t for t in named if t not in terms]
    return label, terms


def fit_formula(train: DataFrame, formula: str, payment_encoding: str = "vocabulary", num_features: int = 1 << 18,
                status_invalid: str = "keep") -> PipelineModel:
    """MLlib's ``RFormula`` with the formula's terms, fitted once on ``train``. Text columns are
    indexed by the alphabet and one-hot encoded; the payment-type set becomes its multi-hot first,
    as a formula knows no arrays."""
    label, terms = formula_terms(formula, train.columns)
    stages = []
    if "payment_types" in terms:
        stages.append(payment_encoder(payment_encoding, num_features))
    right = " + ".join(PAYMENT_VEC if t == "payment_types" else t for t in terms)
    stages.append(RFormula(formula=f"{label} ~ {right}", featuresCol="features", labelCol=label, stringIndexerOrderType="alphabetAsc",
                           handleInvalid=status_invalid))
    return Pipeline(stages=stages).fit(train)


def fit_features(train: DataFrame, formula: str | None = None, **kw) -> PipelineModel:
    return fit_formula(train, formula, **kw) if formula else feature_pipeline(**kw).fit(train)


def multihot_columns(rows: DataFrame, model=None, prefix: str = "payment_") -> DataFrame:
    """``rows`` without its type set and with a 0/1 column for each payment type, in the order of
    their names, read off the vector of the model pipeline's encoder (fitted on ``rows`` if none is given)."""
    rows = rows.where(F.col("payment_types").isNotNull())
    model = model or payment_encoder().fit(rows)
    slots = vector_to_array(PAYMENT_VEC)
    cells = [slots[model.vocabulary.index(t)].cast("bigint").alias(prefix + t) for t in sorted(model.vocabulary)]
    kept = [c for c in rows.columns if c != "payment_types"]
    return model.transform(rows).select(*kept, *cells)
