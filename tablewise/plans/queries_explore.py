"""Exploratory-statistics queries over ``lineitem`` and ``ml_orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import explore, gram
from .catalog import register
from .fixtures import duck_cte, spark_view

ML = duck_cte("ml_orders")
LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ML_NUM = ["price", "balance"]
ML_CAT = ["status", "segment"]


def _li(spark, sf):
    return spark.read.parquet(f"{sf.rstrip('/')}/lineitem.parquet")


def _ml(spark, sf):
    return spark_view(spark, sf, "ml_orders")


def _describe_sql() -> str:
    parts = [
        f"SELECT '{c}' AS field, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        f"round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
        f"round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM lineitem"
        for c in LI_COLS
    ]
    return "\nUNION ALL\n".join(parts)


@register("describe", _describe_sql())
def q_describe(spark, sf):
    """describe() of the lineitem measures with exact interpolated quartiles."""
    return explore.describe(_li(spark, sf), LI_COLS)


def _corr_expr(a: str, b: str) -> str:
    ma = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a} END"
    mb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {b} END"
    return (
        f"round(CASE WHEN stddev_pop({ma}) * stddev_pop({mb}) > 0 "
        f"THEN covar_pop({ma}, {mb}) / (stddev_pop({ma}) * stddev_pop({mb})) END, 6)"
    )


def _corr_sql(table: str, cols: list[str]) -> str:
    parts = [f"SELECT '{a}' AS field_a, '{b}' AS field_b, {_corr_expr(a, b)} AS r FROM {table}" for a in cols for b in cols]
    return "\nUNION ALL\n".join(parts)


@register("correlation_matrix", _corr_sql("lineitem", LI_COLS))
def q_correlation_matrix(spark, sf):
    """Pairwise-complete Pearson matrix (long form), NULL for zero variance."""
    return explore.correlation_matrix(_li(spark, sf), LI_COLS)


def _strongest_sql() -> str:
    parts = []
    for i, a in enumerate(LI_COLS):
        for j, b in enumerate(LI_COLS):
            if i < j:
                parts.append(f"SELECT '{a}' AS field_a, '{b}' AS field_b, {i} AS ia, {j} AS ib, {_corr_expr(a, b)} AS r FROM lineitem")
    return (
        "SELECT field_a, field_b, r FROM (" + "\nUNION ALL\n".join(parts) + ") u WHERE r IS NOT NULL "
        "ORDER BY abs(r) DESC, ia, ib LIMIT 1"
    )


@register("strongest_pair", _strongest_sql())
def q_strongest_pair(spark, sf):
    """Upper-triangle pair with the strongest absolute correlation."""
    return explore.strongest_pair(_li(spark, sf), LI_COLS)


def _gm_sql() -> str:
    return ML + "\nUNION ALL\n".join(
        f"SELECT tier AS class, '{c}' AS field, round(avg({c}), 6) AS mean FROM ml_orders WHERE tier IS NOT NULL GROUP BY tier" for c in ML_NUM
    )


@register(
    "classes_by_mean",
    ML + """SELECT tier AS class, CAST(row_number() OVER (ORDER BY avg(price), tier) AS INTEGER) AS rank,
  round(avg(price), 6) AS mean_price, round(avg(balance), 6) AS mean_balance FROM ml_orders GROUP BY tier""",
)
def q_classes_by_mean(spark, sf):
    """Classes ordered by the mean of one feature, with the means of the shown features."""
    return explore.classes_by_mean(_ml(spark, sf), "tier", ML_NUM, "price")


@register("group_means", _gm_sql())
def q_group_means(spark, sf):
    """Class means of the numeric columns."""
    return explore.group_means(_ml(spark, sf), "tier", ML_NUM)


@register(
    "group_medians",
    ML
    + "\nUNION ALL\n".join(
        f"SELECT tier AS class, '{c}' AS field, round(quantile_cont({c}, 0.5), 6) AS median FROM ml_orders "
        f"WHERE tier IS NOT NULL AND {c} IS NOT NULL GROUP BY tier"
        for c in ML_NUM
    ),
)
def q_group_medians(spark, sf):
    """Exact class medians of the numeric columns."""
    return explore.group_medians(_ml(spark, sf), "tier", ML_NUM)


@register(
    "target_distribution",
    ML
    + """, c AS (SELECT tier AS class, count(*) AS count FROM ml_orders WHERE tier IS NOT NULL GROUP BY tier)
SELECT class, count, round(count / (SELECT count(*) FROM ml_orders), 6) AS ratio,
       count = (SELECT max(count) FROM c) AS is_largest FROM c""",
)
def q_target_distribution(spark, sf):
    """Class counts, ratios and the largest class."""
    return explore.target_distribution(_ml(spark, sf), "tier")


def _crosstab_sql() -> str:
    parts = []
    for c in ML_CAT:
        parts.append(
            f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS category, tier AS class FROM ml_orders "
            f"WHERE {c} IS NOT NULL AND tier IS NOT NULL"
        )
    return (
        ML
        + ", l AS ("
        + " UNION ALL ".join(parts)
        + """), cells AS (SELECT field, category, class, count(*) AS n FROM l GROUP BY ALL),
cats AS (SELECT DISTINCT field, category FROM cells), cls AS (SELECT DISTINCT field, class FROM cells),
grid AS (SELECT cats.field, category, class FROM cats JOIN cls ON cats.field = cls.field)
SELECT g.field, g.category, g.class,
  round(coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY g.field, g.class), 6) AS ratio
FROM grid g LEFT JOIN cells c ON g.field = c.field AND g.category = c.category AND g.class = c.class"""
    )


@register("crosstab_ratio", _crosstab_sql())
def q_crosstab_ratio(spark, sf):
    """Category x class frequencies normalised per class, dense grid with zeros."""
    return explore.crosstab_ratio(_ml(spark, sf), "tier", ML_CAT)


_GMR = (
    ML
    + ", gm AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS field, {i} AS pos, round(avg({c}), 6) AS mean FROM ml_orders WHERE tier IS NOT NULL GROUP BY tier" for i, c in enumerate(ML_NUM))
    + "), r AS (SELECT field, min(pos) AS pos, round(max(mean) - min(mean), 6) AS mean_range FROM gm GROUP BY field)\n"
)


@register("group_mean_range", _GMR + "SELECT field, mean_range FROM r")
def q_group_mean_range(spark, sf):
    """Spread (max - min) of the class means per numeric column."""
    return explore.group_mean_range(_ml(spark, sf), "tier", ML_NUM)


@register("widest_feature", _GMR + "SELECT field, mean_range FROM r ORDER BY mean_range DESC, pos LIMIT 1")
def q_widest_feature(spark, sf):
    """The numeric column whose class means spread the most."""
    return explore.widest_feature(_ml(spark, sf), "tier", ML_NUM)


def _hist_sql(bins: int = 30) -> str:
    parts = [f"SELECT '{c}' AS field, CAST({c} AS DOUBLE) AS x FROM lineitem WHERE {c} IS NOT NULL AND NOT isnan({c})" for c in LI_COLS]
    return f"""WITH l AS ({' UNION ALL '.join(parts)}),
r0 AS (SELECT field, min(x) lo0, max(x) hi0 FROM l GROUP BY field),
r AS (SELECT field, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END hi FROM r0),
c AS (SELECT l.field, CAST(least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin, count(*) AS n
      FROM l JOIN r ON l.field = r.field GROUP BY ALL),
d AS (SELECT field, lo, hi, CAST(b AS INTEGER) AS bin FROM r, range(0, {bins}) t(b))
SELECT d.field, d.bin, round(lo + d.bin * ((hi - lo) / {bins}), 6) AS lower, round(lo + (d.bin + 1) * ((hi - lo) / {bins}), 6) AS upper,
  CAST(coalesce(n, 0) AS BIGINT) AS count
FROM d LEFT JOIN c ON d.field = c.field AND d.bin = c.bin"""


@register("histogram", _hist_sql())
def q_histogram(spark, sf):
    """30-bin equal-width histograms of the lineitem measures (last bin closed)."""
    return explore.histogram(_li(spark, sf), LI_COLS, 30)


@register(
    "category_frequencies",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS field, coalesce(CAST({c} AS VARCHAR), 'nan') AS value, count(*) AS count FROM {t} GROUP BY 2"
        for t, c in (("customer", "c_mktsegment"), ("part", "p_brand"), ("part", "p_size"))
    ),
)
def q_category_frequencies(spark, sf):
    """Value frequencies of categorical columns of customer and part."""
    s = sf.rstrip("/")
    cust = explore.category_frequencies(spark.read.parquet(f"{s}/customer.parquet"), ["c_mktsegment"])
    part = explore.category_frequencies(spark.read.parquet(f"{s}/part.parquet"), ["p_brand", "p_size"])
    return cust.unionByName(part)


def _box_sql() -> str:
    parts = [f"SELECT tier AS class, '{c}' AS field, CAST({c} AS DOUBLE) AS x FROM ml_orders WHERE tier IS NOT NULL AND {c} IS NOT NULL" for c in ML_NUM]
    return (
        ML
        + f""", l AS ({' UNION ALL '.join(parts)}),
q AS (SELECT class, field, quantile_cont(x, 0.25) q1, quantile_cont(x, 0.5) med, quantile_cont(x, 0.75) q3 FROM l GROUP BY class, field)
SELECT q.class, q.field, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round(min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END), 6) AS whisker_low,
  round(max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END), 6) AS whisker_high
FROM q JOIN l ON q.class = l.class AND q.field = l.field GROUP BY q.class, q.field, q1, med, q3"""
    )


@register("boxplot_stats", _box_sql())
def q_boxplot_stats(spark, sf):
    """Per-class quartiles and 1.5-IQR whiskers of the numeric columns."""
    return explore.boxplot_stats(_ml(spark, sf), "tier", ML_NUM)


@register(
    "fixed_sample",
    ML
    + """SELECT * FROM ml_orders ORDER BY md5(concat_ws(':', '42', CAST(row_id AS VARCHAR))), row_id LIMIT 2500""",
)
def q_fixed_sample(spark, sf):
    """Seeded fixed-size sample of min(2500, N) rows."""
    return explore.fixed_sample(_ml(spark, sf), "row_id", 2500, 42)


@register(
    "scatter_sample",
    ML
    + """, s AS (SELECT * FROM ml_orders ORDER BY md5(concat_ws(':', '42', CAST(row_id AS VARCHAR))), row_id LIMIT 2500)
SELECT row_id, tier AS class, price AS x, balance AS y,
  round(15.0 + 1.8 * coalesce(balance - min(balance) OVER (PARTITION BY tier), 0.0), 6) AS size FROM s""",
)
def q_scatter_sample(spark, sf):
    """Seeded scatter sample with per-class marker sizes."""
    return explore.scatter_sample(_ml(spark, sf), "row_id", "tier", "price", "balance", "balance", 2500, 42)


# numeric columns of the line items, two of them with missing values
_LINES = """SELECT CAST(l_quantity AS DOUBLE) AS qty, CAST(l_extendedprice AS DOUBLE) AS price, CAST(l_discount AS DOUBLE) AS discount,
  CAST(l_tax AS DOUBLE) AS tax, CASE WHEN l_orderkey % 3 <> 0 THEN CAST(l_extendedprice AS DOUBLE) END AS price_or_none,
  CASE WHEN l_linenumber <> 2 THEN CAST(l_quantity AS DOUBLE) END AS qty_or_none FROM lineitem"""
_LINE_COLUMNS = ["qty", "price", "discount", "tax", "price_or_none", "qty_or_none"]


@register(
    "correlation_blocks",
    f"WITH l AS ({_LINES}) "
    + " UNION ALL ".join(f"SELECT '{a}' AS field_a, '{b}' AS field_b, round(corr({a}, {b}), 6) AS r FROM l" for a in _LINE_COLUMNS for b in _LINE_COLUMNS),
)
def q_correlation_blocks(spark, sf):
    """Pearson r of every pair of the line items' numbers from masked products of row blocks."""
    spark.read.parquet(f"{sf.rstrip('/')}/lineitem.parquet").createOrReplaceTempView("_lineitem_numbers")
    lines = spark.sql(_LINES.replace("FROM lineitem", "FROM _lineitem_numbers"))
    return gram.correlation_blocks(lines, _LINE_COLUMNS).withColumn("r", F.round("r", 6))
