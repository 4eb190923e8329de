"""Per-order feature blocks and the base table.

Each source table is aggregated once to one row per key before it meets ``orders``:
items (with product attributes) by order, payments by order, payments-per-order by
customer. The aggregates combine partially on the map side, so a hot key costs one
partial buffer per task, and the joins that follow are key-unique on the right side.
Counts that the row-level left join would have produced as 0 for an order without
rows are coalesced back to 0; every other statistic stays null there.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.columns import days_between, minutes_between, safe_ratio
from orderlens.sources.files import Tables, materialize

# The 21 model inputs, in the order the training formula and the scoring assembler use.
FEATURE_COLUMNS = [
    "order_processing_time", "delivery_speed_days", "delivery_accuracy_days",
    "order_month", "order_quarter", "total_item_price", "order_item_count",
    "order_diversity", "Shipping_Cost_Percentage", "order_status", "avg_cust_value",
    "Num_orders", "total_product_category", "order_volume_cm3", "order_weight_kg",
    "avg_prod_name_lenght", "avg_prod_description_lenght", "order_payment_value",
    "nbr_installments", "nbr_payments_used", "payment_types",
]

# Numeric features; ``order_status`` and ``payment_types`` are encoded by the model pipeline.
NUMERIC_FEATURES = [c for c in FEATURE_COLUMNS if c not in ("order_status", "payment_types")]

# Columns filled with the training mean (fixed list of the studied workflow).
IMPUTE_COLUMNS = [
    "order_processing_time", "delivery_speed_days", "delivery_accuracy_days", "total_item_price",
    "order_item_count", "Shipping_Cost_Percentage", "total_product_category", "order_volume_cm3",
    "order_weight_kg", "avg_prod_name_lenght", "avg_prod_description_lenght", "order_payment_value",
    "nbr_installments", "avg_cust_value",
]

# Columns clipped to training percentiles (fixed list of the studied workflow).
WINSOR_COLUMNS = [
    "order_processing_time", "delivery_speed_days", "delivery_accuracy_days", "total_item_price",
    "order_item_count", "order_diversity", "Shipping_Cost_Percentage", "avg_cust_value", "Num_orders",
    "total_product_category", "order_volume_cm3", "order_weight_kg", "avg_prod_name_lenght",
    "avg_prod_description_lenght", "order_payment_value", "nbr_installments", "nbr_payments_used",
]

#: Places of the bitmap of order ids (2 ** ORDER_BITS / 64 rows are broadcast at most).
ORDER_BITS = 26


def time_features(orders: DataFrame) -> DataFrame:
    """Durations and calendar parts of each order (B1-B5).

    processing time in minutes and delivery speed in days difference whole epoch seconds;
    delivery accuracy is signed calendar days, positive when late.
    """
    dt = orders.schema["order_purchase_timestamp"].dataType
    purchase = F.col("order_purchase_timestamp")
    return orders.select(
        "*",
        minutes_between(purchase, F.col("order_approved_at"), dt).alias("order_processing_time"),
        days_between(purchase, F.col("order_delivered_customer_date"), dt).alias("delivery_speed_days"),
        F.datediff("order_delivered_customer_date", "order_estimated_delivery_date").alias("delivery_accuracy_days"),
        F.month(purchase).alias("order_month"),
        F.quarter(purchase).alias("order_quarter"),
    )


def product_facts(products: DataFrame) -> DataFrame:
    """One row per product key: sums over the rows that carry it (one, where keys are unique),
    how many they are, and the categories. A join on it never multiplies item rows."""
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    sums = {"volume": volume, "weight": F.col("product_weight_g"), "name": F.col("product_name_lenght"),
            "description": F.col("product_description_lenght"), "photos": F.col("product_photos_qty")}
    return products.where(F.col("product_id").isNotNull()).groupBy(F.col("product_id").alias("_pid")).agg(
        F.count(F.lit(1)).alias("_rows"), F.collect_set("product_category_name").alias("_categories"),
        *[F.sum(c).alias(f"_{k}") for k, c in sums.items()], *[F.count(c).alias(f"_known_{k}") for k, c in sums.items()])


def item_aggregates(items: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order from one pass over items. Items without an order belong to none and are left out.

    Items are first reduced to one row per (order, product), products to one row per key, and
    their join to one row per order; all three combine on the map side, so neither a hot
    order nor a hot product sits in one task. An item counts in the product statistics once
    for each product row of its key, as in a join of the rows: ``order_price`` is summed that
    way and differs from ``total_item_price`` where product keys are not unique.
    ``n_product_items`` gates the distinct-category count, which is null for an order
    without a known product.
    """
    lines = items.where(F.col("order_id").isNotNull()).groupBy("order_id", "product_id").agg(
        F.sum("price").alias("_price"), F.sum("shipping_cost").alias("_shipping"),
        F.max("order_item_id").alias("_item"), F.count(F.lit(1)).alias("_n"))
    prod = product_facts(products)
    joined = lines.join(prod, lines["product_id"] == prod["_pid"], "left")

    def weighted_avg(c: str):
        return safe_ratio(F.sum(F.col(f"_{c}") * F.col("_n")).cast("double"), F.sum(F.col(f"_known_{c}") * F.col("_n")))
    agg = joined.groupBy("order_id").agg(
        F.sum("_price").alias("total_item_price"),
        F.max("_item").alias("order_item_count"),
        F.count("product_id").alias("order_diversity"),  # a row here is one product of the order
        F.sum("_shipping").alias("_total_shipping_cost"),
        F.sum(F.col("_price") * F.coalesce(F.col("_rows"), F.lit(1))).alias("order_price"),
        F.coalesce(F.sum(F.col("_rows") * F.col("_n")), F.lit(0)).alias("n_product_items"),
        F.size(F.array_distinct(F.flatten(F.collect_set("_categories")))).cast("bigint").alias("_n_categories"),  # bounded by the category names
        F.sum(F.col("_volume") * F.col("_n")).alias("order_volume_cm3"),
        (F.sum(F.col("_weight") * F.col("_n")) / 1000).alias("order_weight_kg"),
        weighted_avg("name").alias("avg_prod_name_lenght"),
        weighted_avg("description").alias("avg_prod_description_lenght"),
        weighted_avg("photos").alias("avg_product_photos_qty"),
    )
    return agg.select(
        "*",
        safe_ratio(F.col("_total_shipping_cost"),
                   F.col("total_item_price") + F.col("_total_shipping_cost")).alias("Shipping_Cost_Percentage"),
        F.when(F.col("n_product_items") > 0, F.col("_n_categories")).alias("total_product_category"),
    ).drop("_total_shipping_cost", "_n_categories")


def payment_totals(payments: DataFrame) -> DataFrame:
    """The customer-value inputs of ``payment_aggregates`` alone: without the type sets they are plain numbers."""
    return payments.groupBy("order_id").agg(F.sum("payment_value").alias("order_payment_value"),
                                            F.count("payment_value").alias("_n_values"), F.count(F.lit(1)).alias("_n_rows"))


def payment_aggregates(payments: DataFrame) -> DataFrame:
    """One row per order with a payment row (B13-B16 plus the customer-value inputs).

    The distinct payment-type count is the size of the type set, so no second distinct
    aggregation (Expand) is planned; the set is bounded by the payment-type vocabulary.
    """
    agg = payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("order_payment_value"),
        F.max("payment_installments").alias("nbr_installments"),
        F.sort_array(F.collect_set("payment_type")).alias("payment_types"),
        F.count("payment_value").alias("_n_values"),
        F.count(F.lit(1)).alias("_n_rows"),
    )
    return agg.withColumn("nbr_payments_used", F.size("payment_types").cast("bigint"))


def customer_value(orders: DataFrame, pay_agg: DataFrame, per_order: bool = False) -> DataFrame:
    """avg_cust_value and Num_orders per customer over all orders (B6, B7).

    Default semantics follow the studied workflow: the orders x payments left join counts
    payment rows (an order without payments counts once) and averages per payment row.
    ``per_order=True`` gives the documented meaning: distinct orders, mean order payment.
    """
    o = orders.select("order_id", "customer_id")
    j = o.join(pay_agg.select("order_id", "order_payment_value", "_n_values", "_n_rows"), "order_id", "left")
    if per_order:
        return j.groupBy("customer_id").agg(
            F.avg("order_payment_value").alias("avg_cust_value"),
            F.count_distinct("order_id").alias("Num_orders"),
        )
    rows = F.when(F.col("order_id").isNull(), 0).otherwise(F.greatest(F.coalesce(F.col("_n_rows"), F.lit(0)), F.lit(1)))
    return j.groupBy("customer_id").agg(
        safe_ratio(F.sum("order_payment_value"), F.sum("_n_values")).alias("avg_cust_value"),
        F.sum(rows).cast("bigint").alias("Num_orders"),
    )


def in_window(orders: DataFrame, start: Optional[str], end: Optional[str],
              end_inclusive_day: bool = False, ts_col: str = "order_purchase_timestamp") -> DataFrame:
    """Closed purchase-time window. A bare end date means its midnight, so later times of
    that day are out unless ``end_inclusive_day``."""
    ts = F.col(ts_col)
    dtype = orders.schema[ts_col].dataType.simpleString()
    cond = F.lit(True)
    if start is not None:
        cond = cond & (ts >= F.lit(start).cast(dtype))
    if end is not None:
        if end_inclusive_day:
            cond = cond & (ts < F.date_add(F.lit(end).cast("date"), 1).cast(dtype))
        else:
            cond = cond & (ts <= F.lit(end).cast(dtype))
    return orders.where(cond)


def maybe_of_orders(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """The rows whose order may be one of ``orders``: all that are, and by chance of the hash some
    others, told before any shuffle. The orders go round as a bitmap of 2 ** ORDER_BITS hashed
    places, 64 in a row, which is bounded at any size."""
    kind = rows.schema["order_id"].dataType
    if kind != orders.schema["order_id"].dataType or not isinstance(kind, (T.IntegralType, T.StringType)):
        return rows  # equal ids of other types may hash apart
    place = F.shiftrightunsigned(F.xxhash64(F.lit("order"), "order_id"), 64 - ORDER_BITS)
    bit = F.expr("shiftleft(1L, CAST(__place & 63 AS INT))")
    found = orders.select(place.alias("__place")).groupBy(F.shiftright("__place", 6).alias("__row")).agg(F.bit_or(bit).alias("__bits"))
    placed = rows.withColumn("__place", place).withColumn("__row", F.shiftright("__place", 6))
    # A semi join, as an exact one that follows would be moved below an inner join.
    hit = (placed["__row"] == found["__row"]) & (found["__bits"].bitwiseAND(bit) != 0)
    return placed.join(F.broadcast(found), hit, "left_semi").select(*[F.col(f"`{c}`") for c in rows.columns])


def of_orders(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """The rows whose order is one of ``orders``: what is aggregated per order and then joined to
    them shuffles no other order's rows."""
    return rows.join(orders.select("order_id"), "order_id", "left_semi")


def order_features(tables: Tables, start: Optional[str] = None, end: Optional[str] = None,
                   end_inclusive_day: bool = False, customer_as_of_window: bool = False,
                   per_order_customer: bool = False, write_payments: bool = True) -> DataFrame:
    """The independent-variable table: one row per order in the purchase window (B23).

    Customer features use every order unless ``customer_as_of_window`` limits them to the
    window (the studied workflow uses all orders, including later ones): of the other orders'
    payments they need totals only. Where the order and its customer both need the whole aggregate, it
    is written once (``write_payments``). The customer's features join first, as the
    other joins and the one to the reviews are all by order. Tables in buckets of the order id do
    without both, as their aggregates and joins by order need no shuffle.
    """
    windowed = in_window(tables.orders, start, end, end_inclusive_day)
    timed = time_features(windowed).select(
        "order_id", "customer_id", "order_status", "order_processing_time", "delivery_speed_days",
        "delivery_accuracy_days", "order_month", "order_quarter")
    whole = start is None and end is None
    if whole:
        items = tables.items
    else:  # the exact join leaves them by order, so that their aggregate needs no shuffle by order and product
        items = of_orders(maybe_of_orders(tables.items, windowed) if write_payments else tables.items, windowed)
    items = item_aggregates(items, tables.products)
    if not write_payments:
        totals = pays = payment_aggregates(tables.payments)
    elif whole:
        totals = pays = materialize(payment_aggregates(tables.payments), "order-payments")
    else:
        # What the bitmap lets through beside the window's orders finds none in the left join.
        pays = payment_aggregates(maybe_of_orders(tables.payments, windowed))
        totals = payment_totals(maybe_of_orders(tables.payments, windowed) if customer_as_of_window else tables.payments)
    cust_orders = windowed if customer_as_of_window else tables.orders
    cust = customer_value(cust_orders, totals, per_order=per_order_customer)

    pays = pays.drop("_n_values", "_n_rows")
    if write_payments:
        j = timed.join(cust, "customer_id", "left").join(items, "order_id", "left").join(pays, "order_id", "left")
    else:
        j = timed.join(items, "order_id", "left").join(pays, "order_id", "left").join(cust, "customer_id", "left")
    return j.select(
        "order_id",
        "order_processing_time", "delivery_speed_days", "delivery_accuracy_days", "order_month",
        "order_quarter", "total_item_price", "order_item_count",
        F.coalesce(F.col("order_diversity"), F.lit(0)).alias("order_diversity"),
        "Shipping_Cost_Percentage", "order_status", "avg_cust_value", "Num_orders",
        "total_product_category", "order_volume_cm3", "order_weight_kg", "avg_prod_name_lenght",
        "avg_prod_description_lenght", "order_payment_value", "nbr_installments",
        F.coalesce(F.col("nbr_payments_used"), F.lit(0)).alias("nbr_payments_used"),
        "payment_types",
        # helper columns: the price check (B17) and the product-info insight (I5)
        "order_price", "avg_product_photos_qty",
        F.coalesce(F.col("n_product_items"), F.lit(0)).alias("n_product_items"),
    )


def binary_label(score, threshold: float = 3.0):
    """1.0 when score > threshold, else 0.0 (a null score gives 0.0)."""
    return F.when(score.cast("double") > F.lit(threshold), 1.0).otherwise(0.0)


def basetable(features: DataFrame, reviews: DataFrame, threshold: float = 3.0,
              keep_score: bool = False, carried: Sequence[str] = ()) -> DataFrame:
    """Features inner-joined to deduped reviews, with the binary label (B24) and the reviews' ``carried`` columns.

    Tied latest reviews of an order each give a row, as in the studied workflow.
    """
    r = reviews.select("order_id", "review_score", *carried)
    out = features.join(r, "order_id", "inner").withColumn("label", binary_label(F.col("review_score"), threshold))
    return out if keep_score else out.drop("review_score")


def multiclass_label(features: DataFrame, reviews: DataFrame) -> DataFrame:
    """Features with the 1-5 review score as a double label (J8)."""
    r = reviews.select("order_id", F.col("review_score").cast("double").alias("label"))
    return features.join(r, "order_id", "inner")
