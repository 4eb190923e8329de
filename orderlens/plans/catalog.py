"""The query catalogue: every operator of the studied workflow as a ``(spark, sf_dir) ->
DataFrame`` query over the driver's test tables.

Queries compose the operators; nothing here computes on the driver except fitted
parameters (one number per column) and model metadata. SQL-checkable outputs round
doubles to 6 places and cast integers to BIGINT, as the oracle does.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.audit import audited_split_base
from orderlens.operators import encode, insights, metrics, quality, reviews, score
from orderlens.operators.features import (
    IMPUTE_COLUMNS, NUMERIC_FEATURES, WINSOR_COLUMNS, basetable, in_window, item_aggregates,
    multiclass_label, order_features, payment_aggregates, time_features, customer_value,
)
from orderlens.operators.prep import (
    TEST, TRAIN, VALIDATION, MeanImputer, ScalarMinMax, Winsorizer, dropna_subset, keyed_split, only, prepare,
)
from orderlens.operators.sketches import COUNT_ERROR, rank_within
from orderlens.plans.oracle import INTEGRAL
from orderlens.plans.params import DECIMALS, W_END, W_START
from orderlens.session import scratch_path
from orderlens.sources.bucketed import bucket_by_order
from orderlens.sources.binding import bind_orders, bind_scored, bind_tables
from orderlens.sources.files import TABLE_FILES, materialize, read_csv, read_tables, register_views, write_csv, write_parquet
from orderlens.sources.schemas import SCHEMAS
from pyspark.sql import types as T


def _r(c: str, digits: int = DECIMALS):
    # the customer mean often lies half-way between two roundings: settled as in the oracle
    nudge = 1e-9 if c == "avg_cust_value" else 0.0
    return F.round(F.col(c).cast("double") + nudge, digits).alias(c)


def _i(c: str):
    return F.col(c).cast("bigint").alias(c)


def _num(c: str):
    return _i(c) if c in INTEGRAL else _r(c)


# ---------------------------------------------------------------- shared builders

def _features(spark, sf):
    return order_features(bind_tables(spark, sf), W_START, W_END)


def _base(spark, sf):
    t = bind_tables(spark, sf)
    return basetable(order_features(t, W_START, W_END), reviews.dedupe_reviews(t.reviews), keep_score=True)


def _prepared(spark, sf):
    return prepare(_base(spark, sf), IMPUTE_COLUMNS, WINSOR_COLUMNS, winsor_method="exact")


AUDITED = ["order_id", *NUMERIC_FEATURES, "order_status", "payment_types"]


def _audited(spark, sf):
    """(split base table, audit), from one job that writes the table."""
    t = bind_tables(spark, sf)
    return audited_split_base(t, reviews.dedupe_reviews(t.reviews), W_START, W_END, AUDITED)


def _split_base(spark, sf):
    return _audited(spark, sf)[0]


def _feature_cols(df: DataFrame, extra=()):
    return df.select("order_id", *[_num(c) for c in NUMERIC_FEATURES], "order_status",
                     F.array_join("payment_types", ",").alias("payment_types"), *extra)


def scoring_columns(df: DataFrame) -> DataFrame:
    return df.select("order_id", *[_r(c) for c in NUMERIC_FEATURES])


# ---------------------------------------------------------------- sources / sinks

def csv_roundtrip(spark, sf):
    t = bind_tables(spark, sf)
    df = (t.orders.select("order_id", "order_status")
          .join(t.items.groupBy("order_id").agg(F.sum("price").alias("total_item_price")), "order_id", "left"))
    path = scratch_path(spark, "csv_roundtrip")
    write_csv(df, path)
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("order_status", T.StringType()),
                           T.StructField("total_item_price", T.DoubleType())])
    return read_csv(spark, path, schema).select("order_id", "order_status", _r("total_item_price"))


def csv_tables_roundtrip(spark, sf):
    """Write the bound tables as CSV, load them as text files are loaded, and derive the order times."""
    folder = scratch_path(spark, "csv_tables")
    tables = bind_tables(spark, sf)
    for f, name in TABLE_FILES.items():
        table, schema = getattr(tables, f), SCHEMAS[name]
        missing = {c.name: F.lit(None).cast(c.dataType) for c in schema if c.name not in table.columns}
        write_csv(table.withColumns(missing).select(*schema.names), f"{folder}/{name}.csv")
    loaded = read_tables(spark, folder)
    o = time_features(loaded.orders)
    return o.select(_i("order_id"), _r("order_processing_time"), _r("delivery_speed_days"),
                    _i("delivery_accuracy_days"), _i("order_month"), _i("order_quarter"))


def parquet_roundtrip(spark, sf):
    t = bind_tables(spark, sf)
    df = (t.orders.select("order_id", "order_status")
          .join(t.items.groupBy("order_id").agg(F.sum("price").alias("total_item_price")), "order_id", "left"))
    path = scratch_path(spark, "parquet_roundtrip")
    write_parquet(df, path)
    return spark.read.parquet(path).select("order_id", "order_status", _r("total_item_price"))


def sql_view_query(spark, sf):
    register_views(bind_tables(spark, sf), prefix="ol_")
    return spark.sql("SELECT order_status, count(*) AS n FROM ol_orders GROUP BY order_status")


# ---------------------------------------------------------------- projections / filters

def order_time_features(spark, sf):
    o = time_features(bind_orders(spark, sf))
    return o.select("order_id", _r("order_processing_time"), _r("delivery_speed_days"),
                    _i("delivery_accuracy_days"), _i("order_month"), _i("order_quarter"))


def label_slices(spark, sf):
    b = materialize(_base(spark, sf).select("label"), "labels")  # read by both filters
    return (b.where("label == 0").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
            .unionByName(b.where("label == 1").groupBy("label").agg(F.count(F.lit(1)).alias("n"))))


def multi_category_orders(spark, sf):
    t = bind_tables(spark, sf)
    ia = item_aggregates(t.items, t.products)
    return ia.where(F.col("total_product_category") > 1).select("order_id", _i("total_product_category"))


def date_window_orders(spark, sf):
    return in_window(bind_orders(spark, sf), W_START, W_END).select("order_id", "order_purchase_timestamp")


def rows_with_any_null(spark, sf):
    t = bind_tables(spark, sf)
    pay = (t.orders.select("order_id").join(payment_aggregates(t.payments), "order_id", "left")
           .select("order_id", "order_payment_value", "nbr_installments",
                   F.coalesce(F.col("nbr_payments_used"), F.lit(0)).alias("nbr_payments_used"), "payment_types"))
    return quality.rows_with_any_null(pay).select("order_id", _r("order_payment_value"), _i("nbr_installments"),
                                                  _i("nbr_payments_used"))


def null_audit(spark, sf):
    return _audited(spark, sf)[1].null_frame(spark)


def numeric_profile(spark, sf):
    features = _features(spark, sf).select("order_status", *NUMERIC_FEATURES)
    p = quality.numeric_profile(features)  # the numeric columns are found from the schema
    return p.select("column_name", _i("n"), _r("mean"), _r("min"), _r("max"))


def price_invariant(spark, sf):
    return _audited(spark, sf)[1].check_frame(spark)


# ---------------------------------------------------------------- reviews

def latest_review(spark, sf):
    r = reviews.latest_reviews(bind_tables(spark, sf).reviews)
    return r.select("review_id", "order_id", _i("review_score"), "review_answer_timestamp")


def unique_reviews(spark, sf):
    r = reviews.dedupe_reviews(bind_tables(spark, sf).reviews)
    return r.select("review_id", "order_id", _i("review_score"), "review_answer_timestamp")


def review_cardinality(spark, sf):
    return reviews.review_cardinality(bind_tables(spark, sf).reviews)


# ---------------------------------------------------------------- feature blocks

def review_cardinality_sketch(spark, sf):
    """The same from HLL sketches: whether each estimate is within four standard errors of the exact count."""
    r = bind_tables(spark, sf).reviews
    exact = reviews.review_cardinality(r).withColumnsRenamed({"n_orders": "orders", "n_reviews": "reviews"})

    def near(a, b):
        return (F.abs(F.col(a) - F.col(b)) <= F.lit(4 * COUNT_ERROR) * F.col(b)).alias(a)
    return exact.join(reviews.review_cardinality(r, approx=True), "stage").select("stage", near("n_orders", "orders"), near("n_reviews", "reviews"))


def customer_value_q(spark, sf):
    t = bind_tables(spark, sf)
    c = customer_value(t.orders, payment_aggregates(t.payments))
    return c.select("customer_id", _r("avg_cust_value"), _i("Num_orders"))


def order_item_features(spark, sf):
    t = bind_tables(spark, sf)
    j = t.orders.select("order_id").join(item_aggregates(t.items, t.products), "order_id", "left")
    return j.select("order_id", _r("total_item_price"), _i("order_item_count"),
                    F.coalesce(F.col("order_diversity"), F.lit(0)).cast("bigint").alias("order_diversity"),
                    _r("Shipping_Cost_Percentage"))


def payment_features(spark, sf):
    t = bind_tables(spark, sf)
    j = t.orders.select("order_id").join(payment_aggregates(t.payments), "order_id", "left")
    return j.select("order_id", _r("order_payment_value"), _i("nbr_installments"),
                    F.coalesce(F.col("nbr_payments_used"), F.lit(0)).cast("bigint").alias("nbr_payments_used"))


def payment_type_sets(spark, sf):
    p = payment_aggregates(bind_tables(spark, sf).payments)
    return p.select("order_id", F.array_join("payment_types", ",").alias("payment_types"))


def payment_multihot(spark, sf):
    """A 0/1 column for each payment type, from the vectors of the pipeline's encoder."""
    pays = payment_aggregates(bind_tables(spark, sf).payments).select("order_id", "payment_types")
    return encode.multihot_columns(materialize(pays, "payment-types"))


def product_features(spark, sf):
    t = bind_tables(spark, sf)
    ia = item_aggregates(t.items, t.products).where(F.col("n_product_items") > 0)
    return ia.select("order_id", _i("total_product_category"), _i("order_volume_cm3"), _r("order_weight_kg"),
                     _r("avg_prod_name_lenght"), _r("avg_prod_description_lenght"))


def status_onehot(spark, sf):
    o = bind_orders(spark, sf)
    model = Pipeline(stages=encode.status_encoder("error")).fit(o)  # every status is known here
    labels = model.stages[0].labels
    out = model.transform(o).select("order_id", vector_to_array(encode.STATUS_VEC).alias("v"))
    return out.select("order_id", *[F.col("v")[i].alias(f"status_{lab}") for i, lab in enumerate(labels[:-1])])


def order_features_q(spark, sf):
    return _feature_cols(_features(spark, sf))


def order_features_bucketed(spark, sf):
    """The same features over tables in buckets of the order id."""
    return _feature_cols(order_features(bucket_by_order(bind_tables(spark, sf)), W_START, W_END, write_payments=False))


def basetable_q(spark, sf):
    return _feature_cols(_base(spark, sf), extra=("label",))


def multiclass_label_q(spark, sf):
    t = bind_tables(spark, sf)
    return multiclass_label(order_features(t, W_START, W_END), reviews.dedupe_reviews(t.reviews)).select(
        "order_id", "label")


# ---------------------------------------------------------------- preparation

def dropna_payment(spark, sf):
    d = dropna_subset(_base(spark, sf), ["payment_types"])
    return d.select("order_id", "label", _r("order_payment_value"), F.array_join("payment_types", ",").alias("payment_types"))


def keyed_split_q(spark, sf):
    return keyed_split(bind_orders(spark, sf).select("order_id"))


def split_sizes(spark, sf):
    return _audited(spark, sf)[1].split_frame(spark)


def split_reunion(spark, sf):
    s = _split_base(spark, sf)
    parts = only(s, TRAIN).unionByName(only(s, TEST)).unionByName(only(s, VALIDATION))
    tagged = (s.select(F.lit(1).alias("b"), F.lit(0).alias("a"))
              .unionByName(parts.select(F.lit(0).alias("b"), F.lit(1).alias("a"))))
    return tagged.agg(F.sum("b").cast("bigint").alias("n_before"), F.sum("a").cast("bigint").alias("n_after"))


def impute_means(spark, sf):
    s = _split_base(spark, sf)
    imp = MeanImputer(IMPUTE_COLUMNS).fit(only(s, TRAIN))
    return imp.parameters(spark).select("column_name", _r("mean"))


def impute_apply(spark, sf):
    s = _split_base(spark, sf)
    imp = MeanImputer(IMPUTE_COLUMNS).fit(only(s, TRAIN))
    return imp.transform(s).select("order_id", "split", *[_num(c) for c in IMPUTE_COLUMNS])


def winsor_bounds(spark, sf):
    s = _split_base(spark, sf)
    filled = MeanImputer(IMPUTE_COLUMNS).fit(only(s, TRAIN)).transform(s)
    w = Winsorizer(WINSOR_COLUMNS, method="exact").fit(only(filled, TRAIN))
    return w.parameters(spark).select("column_name", _r("lo"), _r("hi"))


def winsor_bounds_sketch(spark, sf):
    """Bounds merged from a sketch per month: whether their ranks are within the sketch's error of the wanted ones."""
    s = _split_base(spark, sf)
    train = only(MeanImputer(IMPUTE_COLUMNS).fit(only(s, TRAIN)).transform(s), TRAIN)
    bounds = Winsorizer(WINSOR_COLUMNS, method="sketch").fit(train).bounds
    ranks = train.agg(*[F.struct(F.lit(c).alias("column_name"), rank_within(c, lo, 0.01).alias("lo"),
                                 rank_within(c, hi, 0.99).alias("hi")).alias(c) for c, (lo, hi) in bounds.items()])
    return ranks.select(F.explode(F.array(*map(F.col, bounds))).alias("x")).select("x.*")


def winsorize(spark, sf):
    p = _prepared(spark, sf).data
    return p.select("order_id", "split", *[_r(c) for c in WINSOR_COLUMNS])


def minmax_scale(spark, sf):
    p = _prepared(spark, sf).data
    mm = ScalarMinMax(NUMERIC_FEATURES).fit(only(p, TRAIN))
    return mm.transform(p).select("order_id", "split", *[_r(c) for c in NUMERIC_FEATURES])


# ---------------------------------------------------------------- metrics on the stand-in scores

def merge_predictions(spark, sf):
    s = bind_scored(spark, sf)
    multi = s.where(F.col("label") == 1.0).select(
        "order_id", (F.floor(F.col("probability") * 5) + 1).cast("double").alias("prediction"))
    return score.merge_predictions(s, multi)


def accuracy_q(spark, sf):
    return metrics.accuracy(bind_scored(spark, sf)).select(_r("accuracy"))


def confusion_matrix_q(spark, sf):
    return metrics.confusion_matrix(bind_scored(spark, sf), [0.0, 1.0])


def weighted_f1_q(spark, sf):
    return metrics.weighted_f1(bind_scored(spark, sf)).select(_r("weighted_f1"))


def roc_curve_q(spark, sf):
    return metrics.roc_curve(bind_scored(spark, sf)).select("threshold", _r("tpr"), _r("fpr"))


def auc_q(spark, sf):
    return metrics.auc(bind_scored(spark, sf)).select(_r("auc"))


# ---------------------------------------------------------------- insights

def label_distribution(spark, sf):
    return insights.label_distribution(_base(spark, sf))


def avg_by_label(spark, sf):
    a = insights.avg_by_label(_prepared(spark, sf).data)
    return a.select("label", *[_r(f"avg_{m}") for m in insights.LABEL_METRICS])


def label_gap(spark, sf):
    g = insights.label_gap(_prepared(spark, sf).data)
    return g.select(*[_r(c) for c in g.columns])


def status_by_label(spark, sf):
    return insights.status_by_label(_prepared(spark, sf).data)


def topk_order_status(spark, sf):
    return insights.top_statuses(_prepared(spark, sf).data, 2)


def payment_type_share(spark, sf):
    return insights.payment_type_share(_prepared(spark, sf).data, bind_tables(spark, sf).payments)


def product_info_by_label(spark, sf):
    return insights.product_info_by_label(_prepared(spark, sf).data)


def feature_label_corr(spark, sf):
    c = insights.feature_label_corr(_prepared(spark, sf).data, WINSOR_COLUMNS)
    return c.select("feature", _r("correlation"))


SQL_QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "csv_tables_roundtrip": csv_tables_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "sql_view_query": sql_view_query,
    "order_time_features": order_time_features,
    "label_slices": label_slices,
    "multi_category_orders": multi_category_orders,
    "date_window_orders": date_window_orders,
    "rows_with_any_null": rows_with_any_null,
    "null_audit": null_audit,
    "numeric_profile": numeric_profile,
    "price_invariant": price_invariant,
    "latest_review": latest_review,
    "unique_reviews": unique_reviews,
    "review_cardinality": review_cardinality,
    "review_cardinality_sketch": review_cardinality_sketch,
    "customer_value": customer_value_q,
    "order_item_features": order_item_features,
    "payment_features": payment_features,
    "payment_type_sets": payment_type_sets,
    "payment_multihot": payment_multihot,
    "product_features": product_features,
    "status_onehot": status_onehot,
    "order_features": order_features_q,
    "order_features_bucketed": order_features_bucketed,
    "basetable": basetable_q,
    "multiclass_label": multiclass_label_q,
    "dropna_payment": dropna_payment,
    "keyed_split": keyed_split_q,
    "split_sizes": split_sizes,
    "split_reunion": split_reunion,
    "impute_means": impute_means,
    "impute_apply": impute_apply,
    "winsor_bounds": winsor_bounds,
    "winsor_bounds_sketch": winsor_bounds_sketch,
    "winsorize": winsorize,
    "minmax_scale": minmax_scale,
    "merge_predictions": merge_predictions,
    "accuracy": accuracy_q,
    "confusion_matrix": confusion_matrix_q,
    "weighted_f1": weighted_f1_q,
    "roc_curve": roc_curve_q,
    "auc": auc_q,
    "label_distribution": label_distribution,
    "avg_by_label": avg_by_label,
    "label_gap": label_gap,
    "status_by_label": status_by_label,
    "topk_order_status": topk_order_status,
    "payment_type_share": payment_type_share,
    "product_info_by_label": product_info_by_label,
    "feature_label_corr": feature_label_corr,
}
