"""Connected components by alternating large-star and small-star over an edge table.

Every step is a group with map-side combination and a join that streams the
many side, so a vertex with very many neighbours is never gathered in a task.
Edges live in the shared folder between steps; the driver sees only counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a vertex to the smallest vertex near it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a vertex and its smaller neighbours to the smallest of them (edges point from u to a smaller v)."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, root): for every vertex of ``edges`` (a, b) that is not its component's smallest, that smallest."""
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    now = save(now, "cc")
    before = _state(now)
    while before[0]:
        now = save(_small_star(save(_large_star(now), "cc-large")), "cc-small")
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
