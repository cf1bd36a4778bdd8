import random

import pytest
from pyspark.ml.functions import vector_to_array

from tablewise.operators import dictionary, features
from tablewise.session import scratch_path


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, x double, a string, b string")


ROWS = [(1, 1.5, "red", "x"), (2, 2.5, "green", None), (3, 0.0, "red", "y"), (4, -1.0, None, "x"), (5, 9.0, "blue", "x")]


@pytest.mark.parametrize("partitions", [1, 2, 5])
def test_numbers_run_in_the_order_of_the_values(spark, partitions):
    rng = random.Random(partitions)
    rows = [(i, 0.0, f"v{rng.randrange(90)}", rng.choice(["", "é", "z", None])) for i in range(400)]
    d = dictionary.fit_dictionary(frame(spark, rows), ["a", "b"], max_partitions=partitions)
    got = {f: sorted((r["index"], r["value"], r["count"]) for r in d.entries(f).collect()) for f in ("a", "b")}
    for f, at in (("a", 2), ("b", 3)):
        values = [r[at] for r in rows if r[at] is not None]
        assert got[f] == [(i, v, values.count(v)) for i, v in enumerate(sorted(set(values), key=lambda v: v.encode()))]
        assert d.sizes[f] == len(set(values))


def test_vectors_unseen_nulls_and_rare_values(spark):
    train = frame(spark, ROWS)
    d = dictionary.fit_dictionary(train, ["a", "b"])
    names = {r["place"]: r["feature"] for r in d.feature_names(["x"]).collect()}
    assert names == {0: "x", 1: "a_blue", 2: "a_green", 3: "a_red", 4: "b_x", 5: "b_y"}
    new = frame(spark, [*ROWS, (6, 7.0, "pink", "y")])
    out = d.transform(new, ["x"])
    assert out.columns == ["id", "x", "a", "b", "features"]
    got = {r["id"]: r["v"] for r in out.select("id", vector_to_array("features").alias("v")).collect()}
    want = {i: [x, *[float(a == v) for v in ("blue", "green", "red")], *[float(b == v) for v in ("x", "y")]] for i, x, a, b in [*ROWS, (6, 7.0, "pink", "y")]}
    assert got == want
    assert dictionary.fit_dictionary(train, ["a", "b"], min_count=2).sizes == {"a": 1, "b": 1}


def test_equals_the_generated_one_hot_expressions(spark):
    rng = random.Random(3)
    rows = [(i, rng.random(), rng.choice("pqrs"), rng.choice("uv")) for i in range(300)]
    train = frame(spark, rows)
    fitted = features.fit_features(train, ["x"], ["a", "b"], None, 2)
    own = dictionary.fit_dictionary(train, ["a", "b"]).transform(train).select("id", vector_to_array("features").alias("v"))
    names = fitted.feature_names()
    at = [i for i, n in enumerate(names) if n.startswith(("a_", "b_"))]
    want = {r["id"]: [r["v"][i] for i in at] for r in fitted.transform(train, ["id"], vector=False).select("id", "features").toDF("id", "v").collect()}
    assert {r["id"]: r["v"] for r in own.collect()} == want


def test_saved_and_loaded(spark):
    d = dictionary.fit_dictionary(frame(spark, ROWS), ["a", "b"])
    path = scratch_path(spark, f"test-dictionary-{random.random()}")
    d.save(path)
    again = dictionary.load_dictionary(spark, path, ["a", "b"])
    assert again.sizes == d.sizes and sorted(again.table.collect()) == sorted(d.table.collect())


def test_two_hundred_thousand_categories(spark):
    """The plan has the size of that for three; a row's vector holds two places."""
    few = dictionary.fit_dictionary(frame(spark, ROWS), ["a", "b"])
    many = spark.range(200_000).selectExpr("id", "id / 3D AS x", "concat('c', id) AS a", "IF(id % 2 = 0, 'even', 'odd') AS b")
    d = dictionary.fit_dictionary(many, ["a", "b"])
    assert d.sizes == {"a": 200_000, "b": 2}

    def size(d, df):
        return len(d.indexed(df)._jdf.queryExecution().optimizedPlan().toString().splitlines())

    assert size(d, many) <= size(few, frame(spark, ROWS)) + 4
    rows = d.transform(many, ["x"]).where("id IN (7, 199999)").orderBy("id").collect()
    assert [r["features"].size for r in rows] == [200_003] * 2
    for r in rows:
        assert r["features"].numNonzeros() == 3 and sorted(r["features"].indices)[-1] == 200_001 + r["id"] % 2


def test_an_empty_table(spark):
    d = dictionary.fit_dictionary(frame(spark, ROWS).limit(0), ["a", "b"])
    assert d.sizes == {"a": 0, "b": 0} and d.indexed(frame(spark, ROWS)).where("a_index IS NOT NULL").count() == 0
