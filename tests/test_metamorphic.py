from pyspark.sql import functions as F

from tablewise.operators import audit, explore
from tablewise.plans.fixtures import spark_view
from tablewise.roles import ORDERS_DIRTY

from conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_repartition_and_order_invariance(spark):
    df = spark_view(spark, SF_SMALL, "orders_dirty")
    shuffled = df.repartition(7).orderBy(F.rand(3))
    for fn in (lambda d: audit.numeric_summary(d, ORDERS_DIRTY), lambda d: audit.field_profile(d, ORDERS_DIRTY),
               lambda d: audit.duplicate_rows(d)):
        assert _rows(fn(df)) == _rows(fn(shuffled))


def test_doubling_every_row_doubles_counts(spark):
    df = spark_view(spark, SF_SMALL, "orders_dirty")
    twice = df.unionAll(df)
    a = {r["field"]: r for r in audit.numeric_quality(df, ORDERS_DIRTY).collect()}
    b = {r["field"]: r for r in audit.numeric_quality(twice, ORDERS_DIRTY).collect()}
    for f in a:
        assert b[f]["negative_count"] == 2 * a[f]["negative_count"]
        assert b[f]["infinite_count"] == 2 * a[f]["infinite_count"]
    n = df.count()
    d = audit.duplicate_rows(df).first()["duplicate_row_count"]
    # 2n rows, n - d distinct: every row beyond its first copy is a duplicate
    assert twice.transform(audit.duplicate_rows).first()["duplicate_row_count"] == n + d
    # quantiles are unchanged by duplicating every row only at the extremes
    h1 = {r["field"]: r["count"] for r in explore.histogram(df, ["price"]).groupBy("field").agg(F.sum("count").alias("count")).collect()}
    h2 = {r["field"]: r["count"] for r in explore.histogram(twice, ["price"]).groupBy("field").agg(F.sum("count").alias("count")).collect()}
    assert h2["price"] == 2 * h1["price"]
