"""The end-to-end job: features -> labelled base table -> prepared splits -> fitted
feature pipeline -> model selection -> evaluation -> scoring of an unseen window.

Fitted state (means, bounds, the feature pipeline, models) is fitted on the training
split once and reused for validation, test and scoring. The prepared table is
written to the cluster's checkpoint folder by ``prepare`` before the iterative fits, so a
lost executor re-reads it instead of replaying the whole feature build.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Optional

from pyspark.ml import PipelineModel
from pyspark.ml.feature import MinMaxScaler, SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import encode, reviews as R
from orderlens.operators.features import IMPUTE_COLUMNS, WINSOR_COLUMNS, basetable, in_window, maybe_of_orders, of_orders, order_features
from orderlens.operators.prep import TEST, TRAIN, VALIDATION, Prepared, only, prepare
from orderlens.sources.files import Tables, load_model, save_model


@dataclass
class Workflow:
    spark: SparkSession
    tables: Tables
    start: str
    end: str
    payment_encoding: str = "vocabulary"
    winsor_method: str = "exact"
    prepared: Optional[Prepared] = None
    feature_model: object = None
    _cache: dict = field(default_factory=dict)

    def __post_init__(self):
        reviews = R.dedupe_reviews(self.tables.reviews).select("order_id", "review_score")
        reviews = R.with_order_scores(maybe_of_orders(reviews, in_window(self.tables.orders, self.start, self.end)))
        features = order_features(self.tables, self.start, self.end)
        prepared = prepare(basetable(features, reviews, keep_score=True, carried=[R.ORDER_SCORES]), IMPUTE_COLUMNS, WINSOR_COLUMNS,
                           winsor_method=self.winsor_method)
        self._scored = prepared.data
        self.prepared = replace(prepared, data=prepared.data.drop(R.ORDER_SCORES))
        data = self.prepared.data
        self.feature_model = encode.fit_features(only(data, TRAIN), payment_encoding=self.payment_encoding)

    # ------------------------------------------------------------ binary task
    def assembled(self) -> DataFrame:
        if "assembled" not in self._cache:
            self._cache["assembled"] = self.feature_model.transform(self.prepared.data).select(
                "order_id", "split", "label", "review_score", "features")
        return self._cache["assembled"]

    def split(self, name: str) -> DataFrame:
        """Vectors of one split. Its rows are chosen before they are encoded: the status index counts as
        non-deterministic, so a choice made on ``assembled`` would encode the rows of all splits."""
        return self.feature_model.transform(only(self.prepared.data, name)).select("order_id", "features", "label")

    # ------------------------------------------------------------ five-class task
    def multiclass(self, name: str) -> DataFrame:
        """Same vectors, label = the review score (1..5) of the deduped reviews: a row for each of an
        order's scores, as the join of the vectors to the reviews gives, without joining them again."""
        rows = self.feature_model.transform(only(self._scored, name)).select("order_id", "features", F.explode(R.ORDER_SCORES).alias("r"))
        return rows.select("order_id", "features", F.col("r.review_score").cast("double").alias("label"))

    def scaled(self):
        """MinMax-scaled vectors (fitted on train) for Naive Bayes."""
        if "scaler" not in self._cache:
            self._cache["scaler"] = MinMaxScaler(inputCol="features", outputCol="scaled_features").fit(
                self.multiclass(TRAIN))
        sc = self._cache["scaler"]
        return {s: sc.transform(self.multiclass(s)) for s in (TRAIN, VALIDATION, TEST)}

    # ------------------------------------------------------------ scoring
    def bundle(self, model) -> "ScoringBundle":
        """All that another job needs to score other tables with ``model``."""
        preparation = PipelineModel(stages=[SQLTransformer(statement=NO_TYPES), self.prepared.imputer, self.prepared.winsorizer])
        return ScoringBundle(PipelineModel(stages=[preparation, self.feature_model, model]))


def unseen(tables: Tables, start: str, end: str) -> Tables:
    """The table set of the orders bought in a window, as if it stood alone: no reviews, and
    customer statistics see these orders only."""
    orders = in_window(tables.orders, start, end)
    items, payments = (of_orders(maybe_of_orders(rows, orders), orders) for rows in (tables.items, tables.payments))
    return Tables(orders, items, payments, tables.products)


#: An order without payment rows gets an empty type set.
NO_TYPES = "SELECT * EXCEPT (payment_types), coalesce(payment_types, array()) AS payment_types FROM __THIS__"


@dataclass
class ScoringBundle:
    """One ``PipelineModel`` of three: preparation (training means and bounds), the feature
    pipeline and a classifier. Fitted once, saved whole, and loaded by jobs that score other tables."""

    pipeline: PipelineModel

    @property
    def preparation(self) -> PipelineModel:
        return self.pipeline.stages[0]

    @property
    def feature_model(self) -> PipelineModel:
        return self.pipeline.stages[1]

    @property
    def model(self):
        return self.pipeline.stages[2]

    def prepare(self, tables: Tables) -> DataFrame:
        """Features of every order of ``tables``, built from these tables alone and filled and
        clipped with the training fit."""
        return self.preparation.transform(order_features(tables))

    def features(self, tables: Tables) -> DataFrame:
        return self.feature_model.transform(self.prepare(tables)).select("order_id", "features")

    def save(self, path: str, overwrite: bool = False) -> str:
        """Write the bundle as one folder; fails where there is one unless ``overwrite``, which replaces all of it or nothing."""
        return save_model(self.pipeline, path, overwrite)

    @classmethod
    def load(cls, path: str) -> "ScoringBundle":
        return cls(load_model(PipelineModel, path))
