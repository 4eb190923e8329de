"""Option switches: per-order customer value, windowed customer features, hashed payment types,
and the approximate winsoriser."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.operators import encode
from orderlens.operators.features import customer_value, order_features, payment_aggregates
from orderlens.operators.prep import Winsorizer
from orderlens.sources.binding import bind_tables
from orderlens.sources.schemas import ORDERS, PAYMENTS
from tests.conftest import SF

T0 = dt.datetime(2022, 1, 1)


def _orders(spark):
    return spark.createDataFrame([("o1", "c1", "F", T0, None, None, None, T0),
                                  ("o2", "c1", "F", T0, None, None, None, T0),
                                  ("o3", "c1", "F", T0, None, None, None, T0)], ORDERS)


def test_customer_value_fan_out_and_per_order(spark):
    pays = spark.createDataFrame([("o1", "card", 1, 10.0), ("o1", "card", 1, 20.0), ("o2", "card", 1, 60.0)], PAYMENTS)
    agg = payment_aggregates(pays)
    ref = customer_value(_orders(spark), agg).first()
    assert ref.Num_orders == 4            # 2 payment rows + 1 + an order without payments
    assert abs(ref.avg_cust_value - 30.0) < 1e-12  # mean per payment row
    per = customer_value(_orders(spark), agg, per_order=True).first()
    assert per.Num_orders == 3 and abs(per.avg_cust_value - 45.0) < 1e-12


def test_customer_features_as_of_window(spark):
    t = bind_tables(spark, SF)
    full = order_features(t, "1996-09-01", "1998-06-30")
    win = order_features(t, "1996-09-01", "1998-06-30", customer_as_of_window=True)
    a = full.agg(F.sum("Num_orders")).first()[0]
    b = win.agg(F.sum("Num_orders")).first()[0]
    assert full.count() == win.count() and b < a


def test_hashed_payment_encoding_width(spark):
    df = spark.createDataFrame([(["a", "b"],), (["b"],)], "payment_types array<string>")
    hashed = encode.payment_encoder("hash", 32).transform(df)
    assert hashed.first()["payment_types_dummy"].size == 32
    vocab = encode.payment_encoder("vocabulary").fit(df).transform(df)
    assert vocab.first()["payment_types_dummy"].size == 2


def test_approx_winsoriser_reproduces_min_max_at_one_percent(spark):
    df = spark.range(0, 10000).select(F.col("id").cast("double").alias("x"))
    w = Winsorizer(["x"], method="approx", rel_err=0.01).fit(df)
    lo, hi = w.bounds["x"]
    assert lo <= 100 and hi >= 9899  # rank error up to 1% of n
    exact = Winsorizer(["x"], method="exact").fit(df)
    assert exact.bounds["x"] == pytest.approx((99.99, 9899.01))
