"""Declared schemas of the five logical input tables (no schema inference).

Column names are the ones the order-satisfaction data ships with, including the
misspelt product length columns, so existing files load unchanged.
"""

from pyspark.sql import types as T

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("order_purchase_timestamp", T.TimestampType()),
    T.StructField("order_approved_at", T.TimestampType()),
    T.StructField("order_delivered_carrier_date", T.TimestampType()),
    T.StructField("order_delivered_customer_date", T.TimestampType()),
    T.StructField("order_estimated_delivery_date", T.TimestampType()),
])

ITEMS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_item_id", T.IntegerType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("shipping_cost", T.DoubleType()),
])

PAYMENTS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("payment_installments", T.IntegerType()),
    T.StructField("payment_value", T.DoubleType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_category_name", T.StringType()),
    T.StructField("product_name_lenght", T.IntegerType()),
    T.StructField("product_description_lenght", T.IntegerType()),
    T.StructField("product_photos_qty", T.IntegerType()),
    T.StructField("product_weight_g", T.IntegerType()),
    T.StructField("product_length_cm", T.IntegerType()),
    T.StructField("product_height_cm", T.IntegerType()),
    T.StructField("product_width_cm", T.IntegerType()),
])

REVIEWS = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("review_score", T.IntegerType()),
    T.StructField("review_creation_date", T.TimestampType()),
    T.StructField("review_answer_timestamp", T.TimestampType()),
])

SCHEMAS = {
    "orders": ORDERS,
    "order_items": ITEMS,
    "order_payments": PAYMENTS,
    "products": PRODUCTS,
    "order_reviews": REVIEWS,
}
