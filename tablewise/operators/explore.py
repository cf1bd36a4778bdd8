"""Exploratory statistics as tidy DataFrames.

Moments and correlations come from single wide aggregations (partial
aggregation, one pass); medians and box-plot quartiles from the exact
``orderstats`` quantiles; histograms from a min/max pass plus one grouped
count.  All outputs are long-form and rounded to 6 decimals like the
reference's summaries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import attach_scalars, broadcast_if_small
from ..session import checkpoint
from .gram import correlation_blocks
from .orderstats import DEFAULT_MAX_SORT_ROWS, quantiles, quantiles_wide


def _unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str = "field", value: str = "x") -> DataFrame:
    return df.select(
        *keys,
        F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in columns])).alias("_kv"),
    ).select(*keys, f"_kv.{name}", f"_kv.{value}")


def describe(df: DataFrame, columns: list[str], max_sort_rows: int = DEFAULT_MAX_SORT_ROWS) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles, max of non-null values."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    structs = [
        F.struct(
            F.lit(c).alias("field"),
            F.col(f"n{i}").alias("count"),
            F.round(F.col(f"m{i}"), 6).alias("mean"),
            F.round(F.col(f"s{i}"), 6).alias("std"),
            F.round(F.col(f"lo{i}"), 6).alias("min"),
            F.round(F.col(f"hi{i}"), 6).alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    base = wide.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")
    q = quantiles_wide(df, [], columns, [0.25, 0.5, 0.75], max_sort_rows)
    qw = q.groupBy("field").agg(
        *[F.round(F.max(F.when(F.col("prob") == p, F.col("quantile"))), 6).alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
    )
    return base.join(qw, "field", "left").select("field", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


#: beyond this, three aggregates a pair make too wide a plan
WIDE_COLUMNS = 24


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson r of every ordered column pair over pairwise-complete rows.

    One aggregation computes ``covar_pop`` and the masked population standard
    deviations of all pairs; a zero variance gives NULL (never a divide error).
    Above ``WIDE_COLUMNS`` columns the moments of all pairs come from matrix
    products of row blocks (:mod:`.gram`), in one pass too.
    """
    if len(columns) > WIDE_COLUMNS:
        return correlation_blocks(df, columns).withColumn("r", F.round("r", 6))
    # merged deviations of equal values need not be exactly zero
    aggs = [f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns) for f, n in ((F.min, "lo"), (F.max, "hi"))]
    pairs = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            if j < i:
                continue
            xa, xb = F.col(a).cast("double"), F.col(b).cast("double")
            both = xa.isNotNull() & xb.isNotNull()
            aggs += [
                F.covar_pop(F.when(both, xa), F.when(both, xb)).alias(f"cv{i}_{j}"),
                F.stddev_pop(F.when(both, xa)).alias(f"sa{i}_{j}"),
                F.stddev_pop(F.when(both, xb)).alias(f"sb{i}_{j}"),
            ]
            pairs.append((i, j, a, b))
    wide = df.agg(*aggs)
    structs = []
    for i, j, a, b in pairs:
        r = F.try_divide(F.col(f"cv{i}_{j}"), F.col(f"sa{i}_{j}") * F.col(f"sb{i}_{j}"))
        varies = (F.col(f"lo{i}") < F.col(f"hi{i}")) & (F.col(f"lo{j}") < F.col(f"hi{j}"))
        r = F.when(varies & (F.col(f"sa{i}_{j}") * F.col(f"sb{i}_{j}") > 0), r)
        structs.append(F.struct(F.lit(a).alias("field_a"), F.lit(b).alias("field_b"), F.round(r, 6).alias("r")))
        if i != j:
            structs.append(F.struct(F.lit(b).alias("field_a"), F.lit(a).alias("field_b"), F.round(r, 6).alias("r")))
    return wide.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def strongest_pair(df: DataFrame, columns: list[str]) -> DataFrame:
    """The upper-triangle pair with the largest |r| (first in row-major order on ties)."""
    pos = {c: i for i, c in enumerate(columns)}
    corr = correlation_matrix(df, columns)
    order = F.create_map(*[x for c, i in pos.items() for x in (F.lit(c), F.lit(i))])
    upper = corr.withColumn("_ia", order[F.col("field_a")]).withColumn("_ib", order[F.col("field_b")]).where(
        (F.col("_ia") < F.col("_ib")) & F.col("r").isNotNull()
    )
    return upper.orderBy(F.abs("r").desc(), "_ia", "_ib").limit(1).select("field_a", "field_b", "r")


def group_means(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """Mean of each numeric column per class (long form)."""
    aggs = [F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]
    g = df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("class")).agg(*aggs)
    structs = [F.struct(F.lit(c).alias("field"), F.round(F.col(f"m{i}"), 6).alias("mean")) for i, c in enumerate(columns)]
    return g.select("class", F.explode(F.array(*structs)).alias("_r")).select("class", "_r.field", "_r.mean")


def classes_by_mean(df: DataFrame, target: str, columns: list[str], order_by: str) -> DataFrame:
    """Classes ranked by the mean of one numeric column, with the means of all wanted columns.

    One row per class, so the ranking window spans the label set only; equal
    means rank by class name and classes without values come last."""
    aggs = [F.avg(F.col(c).cast("double")).alias(c) for c in dict.fromkeys([order_by, *columns])]
    g = df.where(F.col(target).isNotNull()).groupBy(F.col(target).cast("string").alias("class")).agg(*aggs)
    w = Window.partitionBy(F.lit(1)).orderBy(F.col(order_by).asc_nulls_last(), "class")
    return g.select("class", F.row_number().over(w).alias("rank"), *[F.round(c, 6).alias(f"mean_{c}") for c in columns])


def group_medians(df: DataFrame, target: str, columns: list[str], max_sort_rows: int = DEFAULT_MAX_SORT_ROWS) -> DataFrame:
    """Exact median of each numeric column per class."""
    base = df.where(F.col(target).isNotNull()).select(F.col(target).alias("class"), *columns)
    q = quantiles_wide(base, ["class"], columns, [0.5], max_sort_rows)
    return q.select("class", "field", F.round("quantile", 6).alias("median"))


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Class counts and ratios over all rows, plus the largest-share flag."""
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    counts = df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("count"))
    out = attach_scalars(counts, total)
    # class table has one row per class (bounded by the label set): global window is fine
    w = Window.partitionBy(F.lit(1))
    return out.select(
        "class",
        "count",
        F.round(F.col("count") / F.col("_n"), 6).alias("ratio"),
        (F.col("count") == F.max("count").over(w)).alias("is_largest"),
    )


def crosstab_ratio(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """Category x class table normalised per class (column), dense with zeros.

    Rows with a missing category or class leave numerator and denominator.
    """
    long = df.select(
        F.col(target).cast("string").alias("class"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("category")) for c in columns])).alias("_kv"),
    ).select("_kv.field", "_kv.category", "class").where(F.col("category").isNotNull() & F.col("class").isNotNull())
    cells = long.groupBy("field", "category", "class").agg(F.count(F.lit(1)).alias("n"))
    cats = cells.select("field", "category").distinct()
    classes = cells.select("field", "class").distinct()
    grid = cats.join(classes, "field").join(cells, ["field", "category", "class"], "left").fillna(0, ["n"])
    w = Window.partitionBy("field", "class")
    return grid.select("field", "category", "class", F.round(F.col("n") / F.sum("n").over(w), 6).alias("ratio"))


def group_mean_range(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """Max minus min of the (rounded) class means per column."""
    gm = group_means(df, target, columns)
    return gm.groupBy("field").agg(F.round(F.max("mean") - F.min("mean"), 6).alias("mean_range"))


def widest_feature(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """The column whose class means spread the most (column order on ties)."""
    pos = {c: i for i, c in enumerate(columns)}
    order = F.create_map(*[x for c, i in pos.items() for x in (F.lit(c), F.lit(i))])
    r = group_mean_range(df, target, columns).withColumn("_pos", order[F.col("field")])
    return r.agg(F.max_by(F.struct("field", "mean_range"), F.struct(F.col("mean_range"), -F.col("_pos"))).alias("w")).select(
        F.col("w.field").alias("field"), F.col("w.mean_range").alias("mean_range")
    )


def histogram(df: DataFrame, columns: list[str], bins: int = 30) -> DataFrame:
    """Equal-width histogram per column, last bin closed, nulls dropped, dense bins."""
    long = _unpivot(df, [], columns).where(F.col("x").isNotNull() & ~F.isnan("x"))
    rng = long.groupBy("field").agg(F.min("x").alias("lo0"), F.max("x").alias("hi0"))
    rng = rng.select(
        "field",
        F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
        F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"),
    )
    # one row per column: broadcast the ranges to every task
    b = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    counts = long.join(broadcast_if_small(rng, len(columns)), "field").groupBy("field", b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    dense = rng.select("field", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return dense.join(counts, ["field", "bin"], "left").select(
        "field",
        "bin",
        F.round(F.col("lo") + F.col("bin") * width, 6).alias("lower"),
        F.round(F.col("lo") + (F.col("bin") + 1) * width, 6).alias("upper"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
    )


def category_frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """Frequency of each value rendered as text (missing shown as 'nan')."""
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("value")) for c in columns])).alias("_kv")
    ).select("_kv.*")
    return long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("count"))


def boxplot_stats(df: DataFrame, target: str, columns: list[str], max_sort_rows: int = DEFAULT_MAX_SORT_ROWS) -> DataFrame:
    """Per class quartiles and whiskers (extreme data within 1.5 IQR), fliers hidden."""
    base = df.where(F.col(target).isNotNull()).select(F.col(target).alias("class"), *columns)
    long = _unpivot(base, ["class"], columns).where(F.col("x").isNotNull())
    q = quantiles(long, ["class", "field"], "x", [0.25, 0.5, 0.75], max_sort_rows)
    qw = q.groupBy("class", "field").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in ((0.25, "q1"), (0.5, "med"), (0.75, "q3"))]
    )
    fences = qw.withColumn("_lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).withColumn(
        "_hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    )
    # (class, field) quartile table: one row per group, so the rows are not shuffled on the class
    fences = checkpoint(fences)
    narrow = fences.select("class", "field", "_lo", "_hi")
    wh = long.join(broadcast_if_small(narrow, narrow.count()), ["class", "field"]).groupBy("class", "field").agg(
        F.min(F.when(F.col("x") >= F.col("_lo"), F.col("x"))).alias("whisker_low"),
        F.max(F.when(F.col("x") <= F.col("_hi"), F.col("x"))).alias("whisker_high"),
    )
    return fences.join(wh, ["class", "field"]).select(
        "class", "field",
        F.round("q1", 6).alias("q1"), F.round("med", 6).alias("median"), F.round("q3", 6).alias("q3"),
        F.round("whisker_low", 6).alias("whisker_low"), F.round("whisker_high", 6).alias("whisker_high"),
    )


def seeded_order(key: str, seed: int):
    """Deterministic pseudo-random order: md5 of 'seed:key' (identical in SQL engines)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def fixed_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """min(n, N) rows chosen by seeded hash order (distributed top-k, no full sort)."""
    return df.withColumn("_o", seeded_order(key, seed)).orderBy("_o", key).limit(n).drop("_o")


def scatter_sample(df: DataFrame, key: str, target: str, x: str, y: str, size_by: str, n: int = 2500, seed: int = 42) -> DataFrame:
    """Seeded sample with marker size 15 + 1.8*(v - class minimum of v within the sample)."""
    s = fixed_sample(df.select(key, target, x, y, size_by), key, n, seed)
    # the sample is bounded by n rows, so a per-class window over it is small
    w = Window.partitionBy(target)
    size = F.lit(15.0) + 1.8 * F.coalesce(F.col(size_by) - F.min(size_by).over(w), F.lit(0.0))
    return s.select(key, F.col(target).alias("class"), F.col(x).alias("x"), F.col(y).alias("y"), F.round(size, 6).alias("size"))
