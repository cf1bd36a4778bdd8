from pyspark.sql import functions as F

from tablewise.operators import prepare


def test_quotas_sum_exactly():
    q = prepare.split_quotas({"a": 7, "b": 13, "c": 10}, (0.7, 0.15, 0.15))
    assert sum(v[0] for v in q.values()) == int(0.7 * 30)
    assert all(sum(v) == n for v, n in zip(q.values(), (7, 13, 10)))


def test_split_disjoint_covering_stratified(spark):
    rows = [(i, ["A", "B", "C"][i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, label string")
    out = prepare.stratified_split(df, "id", "label", (0.7, 0.15, 0.15), 42)
    got = out.groupBy("split", "label").count().collect()
    counts = {(r["split"], r["label"]): r["count"] for r in got}
    assert sum(v for (s, _), v in counts.items() if s == "train") == 42
    assert all(counts[("train", c)] == 14 for c in "ABC")
    assert out.count() == 60 and out.select("id").distinct().count() == 60
    # same split through the bracket (large-group) path of the order statistic
    out2 = prepare.stratified_split(df, "id", "label", (0.7, 0.15, 0.15), 42, max_sort_rows=3)
    a = sorted((r["id"], r["split"]) for r in out.collect())
    b = sorted((r["id"], r["split"]) for r in out2.collect())
    assert a == b


def test_split_matches_row_number_reference(spark):
    rows = [(i, ["A", "B"][i % 2 if i < 50 else 0]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, label string")
    out = {r["id"]: r["split"] for r in prepare.stratified_split(df, "id", "label").collect()}
    h = df.withColumn("h", F.md5(F.concat_ws(":", F.lit("42"), F.col("id").cast("string"))))
    from pyspark.sql import Window

    ranked = h.withColumn("pos", F.row_number().over(Window.partitionBy("label").orderBy("h", "id")) - 1).collect()
    counts = {"A": sum(1 for r in rows if r[1] == "A"), "B": sum(1 for r in rows if r[1] == "B")}
    q = prepare.split_quotas(counts)
    for r in ranked:
        a, v, _ = q[r["label"]]
        want = "train" if r["pos"] < a else ("validation" if r["pos"] < a + v else "test")
        assert out[r["id"]] == want
