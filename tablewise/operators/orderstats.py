"""Exact order statistics and quantiles that scale.

Spark's exact ``percentile`` keeps a value->count map per group inside one
task, and a ``row_number`` window puts a whole group into one task; both break
when one group holds a third of a 100 TB table.  Here:

* groups of at most ``max_sort_rows`` values (a memory bound) are ranked with a
  window, each window partition being bounded by that number;
* larger groups are narrowed by sketch passes.  A pass is one aggregation with
  map-side combination: per wanted rank it counts exactly how many values lie
  below and inside the current bracket and summarises the inside by
  ``percentile_approx`` on a fixed grid.  The grid neighbours of the rank, widened by
  the sketch's error bound, are the next bracket, about ``GRID`` times smaller.
  Rows equal to an end of a bracket are counted by themselves, so a rank among
  frequent equal values is answered at once and otherwise the next bracket lies
  strictly between the ends.  Brackets of at most ``max_sort_rows`` values are
  ranked exactly.

The bracket table (one row per wanted rank of a large group) is broadcast in
blocks of at most ``BLOCK_BRACKETS`` rows, so the data side is never shuffled on
the group key and never broadcast.  Results are exact; linear interpolation
matches numpy/DuckDB ``quantile_cont``/Spark ``percentile``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_SORT_ROWS = 200_000
GRID = 128
ACCURACY = 10_000  # sketch error: at most 1/ACCURACY of the summarised rows in rank
BLOCK_BRACKETS = 50_000
_G = "_grp"


def _with_group(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    if keys:
        return df, list(keys)
    return df.withColumn(_G, F.lit(0)), [_G]


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in df.columns if c not in keys])


def _match(keys: list[str]):
    """Join condition on keys under which nulls are equal."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])


def _sorted_pick(d: DataFrame, gk: list[str], targets: DataFrame) -> DataFrame:
    """Ranks by a window over each group (each bounded by ``max_sort_rows``)."""
    w = Window.partitionBy(*gk).orderBy("_v")
    ranked = d.select(*gk, "_v", (F.row_number().over(w) - 1).alias("_rank"), (F.rank().over(w) - 1).alias("_below"))
    wanted = _renamed(targets.select(*gk, F.col("_rank").alias("_r_rank")), gk)
    return ranked.join(wanted, _match(gk) & (F.col("_rank") == F.col("_r_rank"))).select(*gk, "_rank", F.col("_v").alias("_value"), "_below")


def _next_bracket(r: Row, grid: list[float]) -> tuple:
    """The grid neighbours of the wanted rank, widened by the sketch's error."""
    inside = r["_inside"]
    margin = 2.0 / ACCURACY
    at = (r["_rank"] - r["_below"]) / inside
    low = max((g for g in grid if g <= at - margin), default=None)
    high = min((g for g in grid if g >= at + margin + 1.0 / inside), default=None)
    lo = r["_low"] if low is None else r["_sketch"][grid.index(low)]
    hi = r["_high"] if high is None else r["_sketch"][grid.index(high)]
    return lo, hi


def _narrow(d: DataFrame, gk: list[str], wanted: list[Row], max_sort_rows: int) -> list[tuple]:
    """Brackets (group..., rank, lo, hi, below, the only value inside or None) of a block of wanted ranks of large groups."""
    spark = d.sparkSession
    grid = [i / GRID for i in range(GRID + 1)]
    key_fields = [d.schema[k] for k in gk]
    schema = T.StructType([
        *[T.StructField(f"_r_{f.name}", f.dataType) for f in key_fields], T.StructField("_id", T.LongType()),
        T.StructField("_from", T.DoubleType()), T.StructField("_lo", T.DoubleType()), T.StructField("_hi", T.DoubleType()),
    ])
    # several ranks of a group share a bracket until their brackets part
    state = {i: {"key": tuple(r[k] for k in gk), "rank": r["_rank"], "lo": None, "hi": None, "from": None, "below": 0} for i, r in enumerate(wanted)}
    done: dict[int, tuple] = {}
    while state:
        shared: dict[tuple, list[int]] = {}
        for i, s in state.items():
            shared.setdefault((s["key"], s["from"], s["lo"], s["hi"]), []).append(i)
        rows = [(*key, n, fr, lo, hi) for n, (key, fr, lo, hi) in enumerate(shared)]
        br = F.broadcast(spark.createDataFrame(rows, schema))
        v = F.col("_v").cast("double")
        from_, lo, hi = F.col("_from"), F.col("_lo"), F.col("_hi")
        reach = (from_.isNull() | (v >= from_)) & (hi.isNull() | (v <= hi))
        # the ends are values of the column and may be frequent: they are counted by themselves
        skipped, at_lo, at_hi = lo.isNotNull() & (v < lo), lo.isNotNull() & (v == lo), hi.isNotNull() & (v == hi) & (lo < hi)
        inside = lo.isNull() | ((v > lo) & (v < hi))
        x = F.when(inside, v)

        def ends(where, name):
            y = F.when(where, F.col("_v"))
            return [F.count(y).alias(f"{name}_n"), F.min(y).alias(f"{name}_least"), F.max(y).alias(f"{name}_most")]

        got = (
            d.join(br, _match(gk) & reach)
            .groupBy("_id")
            .agg(F.count_if(skipped).alias("_skipped"), *ends(at_lo, "_at_lo"), *ends(inside, "_inside"), *ends(at_hi, "_at_hi"),
                 F.min(x).alias("_low"), F.max(x).alias("_high"), F.percentile_approx(x, grid, ACCURACY).alias("_sketch"))
            .collect()
        )
        by = {r["_id"]: r for r in got}
        again = {}
        for n, ids in enumerate(shared.values()):
            r = by[n]
            for i in ids:
                s = state[i]
                below = s["below"] + r["_skipped"]
                part = None
                for name, low, high in (("_at_lo", s["lo"], s["lo"]), ("_inside", r["_low"], r["_high"]), ("_at_hi", s["hi"], s["hi"])):
                    if below <= s["rank"] < below + r[f"{name}_n"]:
                        part = name
                        break
                    below += r[f"{name}_n"]
                if part is None:
                    raise RuntimeError("order statistics: a bracket lost its rank (input changed between passes)")
                count = r[f"{part}_n"]
                single = r[f"{part}_least"] == r[f"{part}_most"]
                if count <= max_sort_rows or single:
                    done[i] = (*s["key"], s["rank"], low, high, below, r[f"{part}_least"] if single else None)
                elif low == high:
                    done[i] = (*s["key"], s["rank"], low, high, *_count_values(d, gk, s["key"], low, s["rank"], below))
                else:
                    # strictly between two ends, so every pass leaves two values out
                    lo_, hi_ = _next_bracket(Row(**r.asDict(), _inside=count, _rank=s["rank"], _below=below), grid)
                    again[i] = {"key": s["key"], "rank": s["rank"], "from": low, "lo": lo_, "hi": hi_, "below": below}
        state = again
    return [done[i] for i in sorted(done)]


def _count_values(d: DataFrame, gk: list[str], key: tuple, at: float, rank: int, below: int) -> tuple:
    """(below, value) of a rank among the many values that are one double: they are counted one by one, in order."""
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(x)) for k, x in zip(gk, key, strict=True)])
    for r in d.where(same & (F.col("_v").cast("double") == at)).groupBy("_v").count().orderBy("_v").toLocalIterator():
        if rank < below + r["count"]:
            return below, r["_v"]
        below += r["count"]
    raise RuntimeError("order statistics: a bracket lost its rank (input changed between passes)")


def _bracket_pick(d: DataFrame, gk: list[str], big: DataFrame, max_sort_rows: int) -> DataFrame:
    spark = d.sparkSession
    key_fields = [d.schema[k] for k in gk]
    schema = T.StructType([
        *[T.StructField(f"_r_{f.name}", f.dataType) for f in key_fields], T.StructField("_want", T.LongType()), T.StructField("_lo", T.DoubleType()),
        T.StructField("_hi", T.DoubleType()), T.StructField("_before", T.LongType()), T.StructField("_only", d.schema["_v"].dataType),
    ])
    wanted = big.collect()  # one row per wanted rank of a group of more than max_sort_rows rows
    parts = []
    for begin in range(0, len(wanted), BLOCK_BRACKETS):
        found = _narrow(d, gk, wanted[begin: begin + BLOCK_BRACKETS], max_sort_rows)
        br = spark.createDataFrame(found, schema)
        one = br.where(F.col("_only").isNotNull()).select(
            *[F.col(f"_r_{k}").alias(k) for k in gk], F.col("_want").alias("_rank"), F.col("_only").alias("_value"), F.col("_before").alias("_below")
        )
        inside = d.join(F.broadcast(br.where(F.col("_only").isNull())), _match(gk) & F.col("_v").cast("double").between(F.col("_lo"), F.col("_hi")))
        w = Window.partitionBy(*gk, "_want").orderBy("_v")
        ranked = inside.select(*gk, "_want", "_v", (F.row_number().over(w) - 1 + F.col("_before")).alias("_at"), (F.rank().over(w) - 1 + F.col("_before")).alias("_below"))
        picked = ranked.where(F.col("_at") == F.col("_want")).select(*gk, F.col("_want").alias("_rank"), F.col("_v").alias("_value"), "_below")
        parts += [one, picked]
    return reduce(DataFrame.unionByName, parts)


def order_statistics(
    data: DataFrame,
    keys: list[str],
    value: str,
    targets: DataFrame,
    max_sort_rows: int = DEFAULT_MAX_SORT_ROWS,
) -> DataFrame:
    """Exact k-th smallest value per group.

    ``targets`` holds ``keys + [_rank, _n]``: the 0-based rank wanted among the
    group's non-null values and the group's count.  Returns
    ``keys + [_rank, _value, _below]`` where ``_below`` is the number of values
    strictly smaller than ``_value``.  Values of large groups are compared as
    doubles while brackets narrow, which keeps their order.
    """
    keys = list(keys)
    d = data.select(*keys, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    t = targets.select(*keys, "_rank", "_n")
    d, gk = _with_group(d, keys)
    t, _ = _with_group(t, keys)
    large = t.where(F.col("_n") > max_sort_rows)
    n_large = large.count()
    if not n_large:
        out = _sorted_pick(d, gk, t)
    else:
        small = t.where(F.col("_n") <= max_sort_rows)
        out = _bracket_pick(d, gk, large, max_sort_rows)
        if not small.isEmpty():
            groups = _renamed(large.select(*gk).distinct(), gk)
            rest = d.join(F.broadcast(groups) if n_large <= BLOCK_BRACKETS else groups, _match(gk), "left_anti")
            out = out.unionByName(_sorted_pick(rest, gk, small))
    if not keys:
        out = out.drop(_G)
    return out


def quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: list[float],
    max_sort_rows: int = DEFAULT_MAX_SORT_ROWS,
) -> DataFrame:
    """Exact linearly interpolated quantiles per group: ``keys + [prob, quantile]``.

    Nulls are ignored.  Groups without values produce no rows.
    """
    keys = list(keys)
    d = df.select(*keys, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    counts = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    pos = F.col("prob") * (F.col("_n") - 1)
    targets = (
        counts.select(*keys, "_n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
        .withColumn("_r0", F.floor(pos).cast("long"))
        .withColumn("_r1", F.least(F.col("_r0") + 1, F.col("_n") - 1))
        .withColumn("_f", pos - F.col("_r0"))
    )
    ranks = (
        targets.select(*keys, "_n", F.col("_r0").alias("_rank"))
        .unionByName(targets.select(*keys, "_n", F.col("_r1").alias("_rank")))
        .distinct()
    )
    stats = order_statistics(d, keys, "_x", ranks, max_sort_rows)
    # one reference to ``stats``: both interpolation neighbours come from one join
    need = targets.select(
        *keys, "prob", "_f", F.explode(F.array(
            F.struct(F.lit(0).alias("_side"), F.col("_r0").alias("_rank")),
            F.struct(F.lit(1).alias("_side"), F.col("_r1").alias("_rank")),
        )).alias("_s")
    ).select(*keys, "prob", "_f", "_s._side", "_s._rank")
    right = _renamed(stats.select(*keys, F.col("_rank").alias("_r_rank"), "_value"), keys)
    same = F.col("_rank") == F.col("_r_rank")
    j = need.join(right, (_match(keys) & same) if keys else same)
    out = j.groupBy(*keys, "prob", "_f").agg(
        F.max(F.when(F.col("_side") == 0, F.col("_value"))).alias("_v0"),
        F.max(F.when(F.col("_side") == 1, F.col("_value"))).alias("_v1"),
    )
    q = F.col("_v0") + F.col("_f") * (F.col("_v1") - F.col("_v0"))
    return out.select(*keys, "prob", q.alias("quantile"))


def quantiles_wide(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    probs: list[float],
    max_sort_rows: int = DEFAULT_MAX_SORT_ROWS,
) -> DataFrame:
    """Quantiles of several columns in one pass: ``keys + [field, prob, quantile]``.

    The columns are unpivoted into ``(field, value)`` so one job serves all of
    them; ``field`` becomes part of the group key.
    """
    long = df.select(
        *keys,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value"))
                    for c in columns
                ]
            )
        ).alias("_kv"),
    ).select(*keys, "_kv.field", "_kv.value")
    return quantiles(long, [*keys, "field"], "value", probs, max_sort_rows)
