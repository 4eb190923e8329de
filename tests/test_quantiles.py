import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.operators import ranges
from orderlens.operators.quantiles import _value_counts, exact_quantiles, ranked_ranges
from orderlens.operators.ranges import RANGE, in_ranges, running_totals
from orderlens.sources.files import materialize


@pytest.mark.parametrize("range_values", [100_000, 40, 7])
def test_exact_quantiles_match_numpy(spark, range_values):
    rng = np.random.default_rng(3)
    a = rng.normal(size=997).round(3)          # ties included
    b = rng.integers(0, 5, size=997).astype(float)  # heavy ties
    rows = [(float(x), float(y) if i % 7 else None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    got = exact_quantiles(df, ["a", "b"], [0.01, 0.5, 0.99], range_values=range_values)
    bb = np.array([r[1] for r in rows if r[1] is not None])
    for col, ref in (("a", a), ("b", bb)):
        want = np.percentile(ref, [1, 50, 99])  # linear interpolation = percentile_cont
        assert np.allclose(got[col], want), (col, got[col], want)


def test_dominant_value_does_not_reach_the_ranking(spark):
    """99.99 % one value, rare others on both sides: few rows are put in order."""
    n = 200_000
    x = F.when(F.col("id") < 10, -1.0 - F.col("id")).when(F.col("id") >= n - 10, F.col("id") * 1.0).otherwise(1.0)
    df = spark.range(0, n, 1, 6).select(x.alias("x"), (F.col("id") % 5000).cast("double").alias("y"))
    values = np.sort(np.concatenate([-1.0 - np.arange(10), np.ones(n - 20), np.arange(n - 10, n)]))
    probs = [0.00001, 0.01, 0.5, 0.99, 0.99999]
    got = exact_quantiles(df, ["x", "y"], probs, range_values=100)
    assert np.allclose(got["x"], np.percentile(values, [100 * p for p in probs]))
    assert np.allclose(got["y"], np.percentile(np.arange(n) % 5000, [100 * p for p in probs]))
    counts = materialize(_value_counts(df, ["x", "y"]), "test-counts")
    ranks = spark.createDataFrame([(cid, int(p * (n - 1))) for cid in (0, 1) for p in probs], "cid int, k long")
    rows = ranked_ranges(counts, ranks, range_values=100)
    assert rows.count() <= 2 * len(probs) * 300
    assert rows.groupBy("cid", RANGE).count().agg(F.max("count")).first()[0] <= 300


def test_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert exact_quantiles(df, ["a"], [0.01, 0.99]) == {"a": [None, None]}


def test_a_thousand_ranges(spark):
    """Every row knows its range, the plan looks through no list of cuts, and running totals agree with a global sort."""
    df = spark.range(0, 40_000, 1, 4).select((F.col("id") * 7919 % 39_989).alias("x"), (F.col("id") % 5).alias("y"))
    rows = materialize(df.groupBy("x").agg(F.sum("y").alias("y")), "test-rows")
    ranged = in_ranges(rows, [F.col("x")], 40)
    sizes = ranged.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy(RANGE).collect()
    assert len(sizes) >= 990 and all(a["hi"] < b["lo"] for a, b in zip(sizes, sizes[1:]))
    out = running_totals(ranged, ["y"], [F.col("x")])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "filter(" not in plan.lower().replace("filter (", "")
    got = [(r["x"], r["cum_y"]) for r in out.orderBy("x").collect()]
    known = sorted((r["x"], r["y"]) for r in rows.collect())
    assert [x for x, _ in got] == [x for x, _ in known]
    assert [c for _, c in got] == np.cumsum([y for _, y in known]).tolist()


def test_ranges_are_bounded_in_number(spark, monkeypatch):
    monkeypatch.setattr(ranges, "MAX_RANGES", 3)
    rows = materialize(spark.range(100).select(F.col("id").alias("x")), "test-rows")
    assert in_ranges(rows, [F.col("x")], 2).select(RANGE).distinct().count() <= 3
