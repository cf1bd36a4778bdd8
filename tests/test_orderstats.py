import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

import pytest
from tablewise.operators.orderstats import order_statistics, quantiles


def _check(spark, pdf, probs, max_sort_rows):
    got = quantiles(spark.createDataFrame(pdf), ["g"], "v", probs, max_sort_rows).toPandas()
    exp = pdf.dropna().groupby("g")["v"].quantile(probs).reset_index()
    exp.columns = ["g", "prob", "quantile"]
    m = got.merge(exp, on=["g", "prob"], suffixes=("_s", "_p"))
    assert len(m) == len(exp) == len(got)
    assert np.allclose(m["quantile_s"], m["quantile_p"], rtol=1e-12, atol=1e-12)


def test_window_and_bracket_paths_are_exact(spark):
    rng = np.random.default_rng(7)
    n = 5000
    g = np.where(rng.random(n) < 0.5, "hot", rng.choice(["a", "b"], n))
    v = np.round(rng.normal(size=n) * 10, 1)
    v[rng.random(n) < 0.25] = 3.0  # heavy ties
    v[:3] = [1e300, -1e300, 0.0]  # extreme outliers
    pdf = pd.DataFrame({"g": g, "v": v})
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    _check(spark, pdf, probs, 10**9)  # windowed path
    _check(spark, pdf, probs, 200)  # histogram-bracket path for every group


def test_long_values_and_null_groups(spark):
    rng = np.random.default_rng(8)
    v = rng.integers(1 << 58, 1 << 60, 3000)
    g = np.where(rng.random(3000) < 0.6, None, "b")
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v}))
    t = df.groupBy("g").count().selectExpr("g", "explode(array(0, 7, cast(count / 2 as int), cast(count - 1 as int))) AS _rank", "count AS _n")
    for limit in (10_000, 50):
        got = {(r["g"], r["_rank"]): (r["_value"], r["_below"]) for r in order_statistics(df, ["g"], "v", t, limit).collect()}
        for (key, rank), (value, below) in got.items():
            mine = np.sort(v[[x is None if key is None else x == key for x in g]])
            assert value == mine[rank] and below == (mine < value).sum()
        assert len(got) == 8


@pytest.mark.parametrize("threshold", ["1048576", "10485760"])
def test_large_groups_are_not_shuffled_on_their_key(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = spark.range(20_000).selectExpr("id % 2 AS g", "cast(id * 37 % 20011 as double) AS v")
        t = df.groupBy("g").count().selectExpr("g", "5000L AS _rank", "count AS _n")
        plan = order_statistics(df, ["g"], "v", t, 1000)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BuildLeft" not in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60))
def test_random_small_groups(spark, values):
    pdf = pd.DataFrame({"g": ["x"] * len(values), "v": [float(x) for x in values]})
    _check(spark, pdf, [0.1, 0.5, 0.9], 7)


def test_ranks_at_the_border_of_frequent_values(spark):
    n = 4000
    halves = [(f"z{z}", float(i >= z)) for z in (1980, 1999, 2000, 2001, 2020) for i in range(n)]  # 0/1, border within a grid step of the median
    fifty = [("fifty", float(i % 50 + 1)) for i in range(n)]  # a border at exactly 50 %
    neighbours = [("near", x) for x in [1.0] * 1990 + [1.5] * 20 + [2.0] * 1990]  # the rank lies strictly between two frequent values
    pdf = pd.DataFrame(halves + fifty + neighbours, columns=["g", "v"])
    _check(spark, pdf, [0.0, 0.02, 0.25, 0.495, 0.5, 0.505, 0.75, 1.0], 60)


def test_many_long_values_that_are_one_double(spark):
    v = np.sort(np.repeat((1 << 60) + np.arange(-20, 20), 50))  # doubles are 128 to 256 apart here
    df = spark.createDataFrame(pd.DataFrame({"g": ["x"] * len(v), "v": v}))
    t = spark.createDataFrame([("x", r, len(v)) for r in (0, 999, 1000, 1999)], "g string, _rank long, _n long")
    got = {r["_rank"]: (r["_value"], r["_below"]) for r in order_statistics(df, ["g"], "v", t, 60).collect()}
    assert got == {r: (v[r], (v < v[r]).sum()) for r in (0, 999, 1000, 1999)}
