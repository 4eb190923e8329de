"""Spark catalogue queries versus their DuckDB oracle SQL on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from orderlens.plans.oracle import queries_sql
from tests.conftest import SF

CHECK = sorted(queries_sql())


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return None if isinstance(v, float) and math.isnan(v) else round(float(v), 6)
    return v


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["orders", "lineitem", "part"]:
        c.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", CHECK)
def test_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    dk = con.sql(E.oracle_sql()[name]).df()
    assert _rows(sp) == _rows(dk)


def test_every_query_has_a_callable():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 55


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "label" in df.columns
