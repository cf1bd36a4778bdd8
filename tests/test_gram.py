import numpy as np
import pytest

from tablewise.operators import explore, gram


def frame(spark, values, parts=3):
    names = [f"x{i}" for i in range(values.shape[1])]
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in values.tolist()]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(parts), names


def matrix(df, names):
    at = {n: i for i, n in enumerate(names)}
    out = np.full((len(names), len(names)), np.nan)
    rows = df.collect()
    assert len(rows) == len(names) ** 2
    for r in rows:
        out[at[r["field_a"]], at[r["field_b"]]] = np.nan if r["r"] is None else r["r"]
    return out


def sample(n, width, seed=1):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, width)) @ rng.normal(size=(width, width)) * 3 + 1e4 * rng.normal(size=width)
    values[rng.random(values.shape) < 0.2] = np.nan
    values[:, 2] = 7.25  # no variance
    values[:, 4] = np.where(np.arange(n) % 2 == 0, np.nan, values[:, 4])
    values[:, 5] = np.where(np.arange(n) % 2 == 0, values[:, 5], np.nan)  # never together with column 4
    values[:, 6] = np.nan
    return values


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_equals_the_pairwise_aggregates(spark, parts):
    df, names = frame(spark, sample(200, 9), parts)
    want = matrix(explore.correlation_matrix(df, names), names)
    got = matrix(gram.correlation_blocks(df, names), names)
    assert np.allclose(got, want, atol=2e-6, equal_nan=True)
    assert np.isnan(got[2]).all() and np.isnan(got[4, 5]) and not np.isnan(got[0, 1])


def test_a_thousand_columns_in_one_pass(spark):
    values = sample(300, 1000, 4)
    df, names = frame(spark, values, 2)
    plan = gram.correlation_blocks(df, names)
    assert str(plan._jdf.queryExecution().executedPlan().toString()).count("MapInArrow") == 1
    got = matrix(explore.correlation_matrix(df, names), names)
    for i, j in ((0, 1), (3, 999), (500, 7), (12, 12)):
        both = ~np.isnan(values[:, i]) & ~np.isnan(values[:, j])
        assert got[i, j] == pytest.approx(np.corrcoef(values[both, i], values[both, j])[0, 1], abs=2e-6)
    assert np.allclose(got, got.T, equal_nan=True)


def test_values_that_are_not_finite_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, float("nan"), 2.0), (2.0, None, 1.0), (4.0, 3.0, 0.5)], "a double, b double, c double")
    got = {(r["field_a"], r["field_b"]): r["r"] for r in gram.correlation_blocks(df, ["a", "b", "c"]).collect()}
    assert np.isnan(got["a", "b"]) and np.isnan(got["b", "b"]) and got["a", "a"] == pytest.approx(1.0) and got["a", "c"] < -0.9
    assert gram.correlation_blocks(df.limit(0), ["a", "b"]).count() == 0
