import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewise.operators import features, kmeans1d


def lloyd(x, start, threshold, max_iter):
    """Row by row: every value to its nearest centre, ties to the smaller one."""
    now, steps = np.array(start, float), 0
    for _ in range(max_iter):
        near = np.abs(x[:, None] - now).argmin(1)
        new = np.array([x[near == k].mean() if (near == k).any() else now[k] for k in range(len(now))])
        steps += 1
        done = ((new - now) ** 2).sum() <= threshold
        now = new
        if done:
            break
    return now, steps


def columns(n=4_000):
    rng = np.random.default_rng(5)
    heavy = np.where(rng.random(n) < 0.35, 3.25, rng.lognormal(1.0, 1.2, n))  # one value holds a third of the rows
    return {"heavy": heavy, "even": rng.uniform(-50, 50, n), "few": rng.choice([0.0, 1.0, 2.2, 3.7, 4.1, 5.9, 8.0], n), "one": np.full(n, 2.5)}


@pytest.fixture(scope="module")
def table(spark):
    data = columns()
    rows = [tuple(map(float, r)) for r in zip(*data.values())]
    return data, spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(5)


@pytest.mark.parametrize("max_cells", [50_000, 64, 1])
def test_edges_equal_lloyd_over_all_rows(table, max_cells):
    data, df = table
    got = features.fit_kmeans_edges(df, list(data), dict.fromkeys(data, 0.0), n_bins=9, max_cells=max_cells)
    for c, x in data.items():
        grid = np.linspace(x.min(), x.max(), 10)
        want, _ = lloyd(x, (grid[1:] + grid[:-1]) / 2, 1e-4 * x.var(), 300)
        edges = features.merge_close_edges([x.min(), *(want[1:] + want[:-1]) / 2, x.max()])
        assert np.allclose(got[c], edges, rtol=0, atol=1e-8), c


def test_cells_hold_equally_many_values(table):
    data, df = table
    long = df.select(F.lit("even").alias("field"), F.col("even").alias("x"))
    cells = kmeans1d.value_cells(long, 64)
    sizes = [r["n"] for r in cells.groupBy("cell").agg(F.count("x").alias("n")).collect()]
    assert len(sizes) <= 64 and max(sizes) == -(-len(set(data["even"])) // 64)
    low, high = (np.array([r[0] for r in cells.groupBy("cell").agg(f("x")).orderBy("cell").select(f"{f.__name__}(x)").collect()]) for f in (F.min, F.max))
    assert (high[:-1] < low[1:]).all()  # cells are neighbouring intervals of the sorted values


def test_iterations_start_no_job_when_borders_stay(table):
    data, df = table
    x = data["even"]
    start = np.linspace(x.min(), x.max(), 8)
    fine = kmeans1d.prefixes(kmeans1d.value_cells(df.select(F.lit("even").alias("field"), F.col("even").alias("x"))))["even"]
    want, steps = lloyd(x, start, 0.0, 60)
    assert steps > 20 and np.allclose(kmeans1d.centres(fine, start, 0.0, 60), want) and fine.reads == 0
    coarse = kmeans1d.prefixes(kmeans1d.value_cells(df.select(F.lit("even").alias("field"), F.col("even").alias("x")), 64))["even"]
    assert np.allclose(kmeans1d.centres(coarse, start, 0.0, 60), want) and 0 < coarse.reads < steps
    assert len(coarse.known) <= 64


def test_nulls_nans_and_no_rows(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,), (9.0,)], "x double")
    assert features.fit_kmeans_edges(df, ["x"], {"x": 5.0}, n_bins=2)["x"] == pytest.approx([1.0, (11 / 3 + 9) / 2, 9.0])  # 1, 5, 5 and 9
    assert features.fit_kmeans_edges(df.limit(0), ["x"], {"x": 5.0}) == {} and features.fit_kmeans_edges(df, [], {}) == {}


def test_values_half_way_belong_to_the_smaller_centre(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "x double")  # centres 0.5 and 1.5 first, 1.0 between them
    assert features.fit_kmeans_edges(df, ["x"], {"x": 0.0}, n_bins=2)["x"] == [0.0, 1.25, 2.0]
