"""Audit queries over the ``orders_dirty`` / ``ml_orders`` views."""

from __future__ import annotations

from dataclasses import replace

from ..functions.exprs import INF_TOKENS, NUMBER_RE
from ..operators import audit
from ..roles import ML_ORDERS, ORDERS_DIRTY
from .catalog import register
from .fixtures import duck_cte, spark_view

OD = duck_cte("orders_dirty")
ML = duck_cte("ml_orders")

# Declared schema for the schema check: the audit expects a customer column
# the dirty view does not carry, in a different order.
SCHEMA_ROLES = replace(
    ORDERS_DIRTY, required=("o_orderkey", "o_custkey", "price", "price_txt", "status", "priority")
)


def _od(spark, sf):
    return spark_view(spark, sf, "orders_dirty")


def _ml(spark, sf):
    return spark_view(spark, sf, "ml_orders")


# ---- SQL helpers for the oracles -------------------------------------------
_INF_LIST = ", ".join(f"'{t}'" for t in INF_TOKENS)


def _sql_num(c: str, kind: str) -> str:
    if kind == "string":
        return (
            f"(CASE WHEN regexp_matches(trim({c}), '{NUMBER_RE}') OR lower(trim({c})) IN ({_INF_LIST}) "
            f"THEN TRY_CAST(trim({c}) AS DOUBLE) END)"
        )
    return f"CAST({c} AS DOUBLE)"


def _sql_fin(c: str, kind: str) -> str:
    x = _sql_num(c, kind)
    return f"(CASE WHEN isfinite({x}) THEN {x} END)"


_STRIP = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
OD_NUMERIC = [("o_orderkey", "bigint"), ("price", "double"), ("price_txt", "string")]


@register(
    "target_summary",
    OD
    + """, c AS (SELECT CAST(priority AS VARCHAR) v, count(*) c FROM orders_dirty
             WHERE priority IS NOT NULL GROUP BY 1)
SELECT (SELECT count(*) FROM c) AS class_count, m.v AS most_frequent, m.c AS most_count,
       l.v AS least_frequent, l.c AS least_count, round(m.c / l.c, 6) AS max_min_ratio,
       (m.c / l.c) >= 1.5 AS is_imbalanced
FROM (SELECT * FROM c ORDER BY c DESC, v LIMIT 1) m, (SELECT * FROM c ORDER BY c ASC, v LIMIT 1) l""",
)
def q_target_summary(spark, sf):
    """Class count, most/least frequent class, ratio and imbalance flag of the target."""
    return audit.target_summary(_od(spark, sf), ORDERS_DIRTY)


@register(
    "dataset_summary",
    OD
    + """SELECT count(*) AS row_count, CAST(5 AS BIGINT) AS column_count,
  'o_orderkey,price_txt,price,status,priority' AS columns,
  'o_orderkey,price' AS numeric_columns, 'price_txt,status,priority' AS non_numeric_columns
FROM orders_dirty""",
)
def q_dataset_summary(spark, sf):
    """Row and column counts, column list, numeric vs non-numeric columns."""
    return audit.dataset_summary(_od(spark, sf), ORDERS_DIRTY)


def _profile_sql() -> str:
    cols = [("o_orderkey", "bigint"), ("price_txt", "string"), ("price", "double"), ("status", "string"), ("priority", "string")]
    parts = []
    for i, (c, t) in enumerate(cols):
        miss = f"({c} IS NULL OR isnan({c}))" if t == "double" else f"{c} IS NULL"
        distinct = f"count(DISTINCT CASE WHEN NOT isnan({c}) THEN {c} END)" if t == "double" else f"count(DISTINCT {c})"
        parts.append(
            f"SELECT '{c}' AS field, CAST({i} AS BIGINT) AS position, '{t}' AS dtype, "
            f"count(*) - count_if({miss}) AS non_null_count, count_if({miss}) AS missing_count, "
            f"round(count_if({miss}) / count(*), 6) AS missing_ratio, {distinct} AS unique_count FROM orders_dirty"
        )
    return OD + "\nUNION ALL\n".join(parts)


@register("field_profile", _profile_sql())
def q_field_profile(spark, sf):
    """Per column position, dtype, non-null, missing, missing ratio, exact distinct count."""
    return audit.field_profile(_od(spark, sf), ORDERS_DIRTY)


@register(
    "missing_total",
    OD
    + """SELECT CAST(count_if(o_orderkey IS NULL) + count_if(price_txt IS NULL) + count_if(price IS NULL OR isnan(price))
  + count_if(status IS NULL) + count_if(priority IS NULL) AS BIGINT) AS total_missing,
  round((count_if(o_orderkey IS NULL) + count_if(price_txt IS NULL) + count_if(price IS NULL OR isnan(price))
  + count_if(status IS NULL) + count_if(priority IS NULL)) / (count(*) * 5), 6) AS total_missing_ratio
FROM orders_dirty""",
)
def q_missing_total(spark, sf):
    """D3: total missing cells and their ratio over rows x columns."""
    return audit.missing_total(_od(spark, sf))


@register(
    "duplicate_rows",
    OD
    + """SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_row_count,
  round(coalesce(sum(c - 1), 0) / (SELECT count(*) FROM orders_dirty), 6) AS duplicate_row_ratio
FROM (SELECT count(*) AS c FROM orders_dirty GROUP BY o_orderkey, price_txt, price, status, priority) g""",
)
def q_duplicate_rows(spark, sf):
    """Exact duplicate rows beyond the first (nulls equal), via hash prefilter + full-row group."""
    return audit.duplicate_rows(_od(spark, sf))


def _dist_sql() -> str:
    parts = [
        f"SELECT '{c}' AS field, coalesce(CAST({c} AS VARCHAR), '<MISSING>') AS value, count(*) AS count, "
        f"round(count(*) / (SELECT count(*) FROM orders_dirty), 6) AS ratio FROM orders_dirty GROUP BY 2"
        for c in ("status", "priority")
    ]
    return OD + "\nUNION ALL\n".join(parts)


@register("value_distribution", _dist_sql())
def q_value_distribution(spark, sf):
    """Value counts and ratios (missing as <MISSING>) of the categorical columns and target."""
    return audit.value_distribution(_od(spark, sf), ["status", "priority"])


def _numsum_sql() -> str:
    parts = []
    for c, t in OD_NUMERIC:
        fin = _sql_fin(c, t)
        parts.append(
            f"SELECT '{c}' AS field, count({c}) AS count, count({fin}) AS finite_count, "
            f"round(avg({fin}), 6) AS mean, round(stddev_samp({fin}), 6) AS std, round(min({fin}), 6) AS min, "
            f"round(quantile_cont({fin}, 0.25), 6) AS q25, round(quantile_cont({fin}, 0.5), 6) AS q50, "
            f"round(quantile_cont({fin}, 0.75), 6) AS q75, round(max({fin}), 6) AS max FROM orders_dirty"
        )
    return OD + "\nUNION ALL\n".join(parts)


@register("numeric_summary", _numsum_sql())
def q_numeric_summary(spark, sf):
    """Count (incl. Inf), finite count, mean, sample std, min, exact quartiles, max."""
    return audit.numeric_summary(_od(spark, sf), ORDERS_DIRTY)


def _numq_sql() -> str:
    parts = []
    for c, t in OD_NUMERIC:
        x = _sql_num(c, t)
        fin = _sql_fin(c, t)
        lo, hi = ORDERS_DIRTY.ranges.get(c, (None, None))
        out = f"count_if({fin} < {lo} OR {fin} > {hi})" if lo is not None else "CAST(0 AS BIGINT)"
        unreasonable = f"count_if({fin} = 0)" if (lo is not None and lo > 0) else "CAST(0 AS BIGINT)"
        parts.append(
            f"SELECT '{c}' AS field, count_if({fin} < 0) AS negative_count, count_if({fin} = 0) AS zero_count, "
            f"{unreasonable} AS unreasonable_zero_count, count_if(isinf({x})) AS infinite_count, "
            f"count_if({c} IS NOT NULL AND {x} IS NULL) AS non_numeric_count, {out} AS outside_range_count FROM orders_dirty"
        )
    return OD + "\nUNION ALL\n".join(parts)


@register("numeric_quality", _numq_sql())
def q_numeric_quality(spark, sf):
    """Negative, zero, unreasonable-zero, infinite, non-numeric and out-of-range counters."""
    return audit.numeric_quality(_od(spark, sf), ORDERS_DIRTY)


def _iqr_sql() -> str:
    parts = []
    for c, t in [("price", "double"), ("price_txt", "string")]:
        fin = _sql_fin(c, t)
        parts.append(
            f"SELECT '{c}' AS field, round(q1 - 1.5 * (q3 - q1), 6) AS iqr_lower, round(q3 + 1.5 * (q3 - q1), 6) AS iqr_upper, "
            f"(SELECT count_if({fin} < q1 - 1.5 * (q3 - q1) OR {fin} > q3 + 1.5 * (q3 - q1)) FROM orders_dirty) AS iqr_extreme_count "
            f"FROM (SELECT quantile_cont({fin}, 0.25) q1, quantile_cont({fin}, 0.75) q3 FROM orders_dirty) q"
        )
    return OD + "\nUNION ALL\n".join(parts)


@register("iqr_outliers", _iqr_sql())
def q_iqr_outliers(spark, sf):
    """Tukey fences from exact quartiles and the count of finite values outside them."""
    return audit.iqr_outliers(_od(spark, sf), ORDERS_DIRTY)


_S = _STRIP.format(c="status")


@register(
    "categorical_quality",
    OD
    + f"""SELECT 'status' AS field, count(DISTINCT status) AS unique_count,
  count_if(status <> {_S}) AS whitespace_count, count_if({_S} = '') AS empty_string_count
FROM orders_dirty""",
)
def q_categorical_quality(spark, sf):
    """Distinct count, leading/trailing whitespace and blank counters per categorical column."""
    return audit.categorical_quality(_od(spark, sf), ORDERS_DIRTY)


@register(
    "case_conflicts",
    OD
    + f"""SELECT 'status' AS field, lower(v) AS folded, count(*) AS n_spellings,
  string_agg(v, '|' ORDER BY v) AS spellings
FROM (SELECT DISTINCT {_S} AS v FROM orders_dirty WHERE status IS NOT NULL AND {_S} <> '') d
GROUP BY lower(v) HAVING count(*) > 1""",
)
def q_case_conflicts(spark, sf):
    """Spellings that differ only by case after stripping, grouped."""
    return audit.case_conflicts(_od(spark, sf), ORDERS_DIRTY)


@register(
    "unexpected_values",
    OD
    + """SELECT DISTINCT 'status' AS field, status AS value FROM orders_dirty
  WHERE status IS NOT NULL AND status NOT IN ('F', 'O', 'P')
UNION ALL
SELECT DISTINCT 'priority' AS field, priority AS value FROM orders_dirty
  WHERE priority IS NOT NULL AND priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')""",
)
def q_unexpected_values(spark, sf):
    """Observed values missing from the allow-lists (anti join against the list)."""
    return audit.unexpected_values(_od(spark, sf), ORDERS_DIRTY)


@register("similar_values")
def q_similar_values(spark, sf):
    """C4: near-identical spellings (Ratcliff-Obershelp >= 0.8) via prefix-filter candidate join."""
    return audit.similar_values(_od(spark, sf), ORDERS_DIRTY)


@register(
    "part_type_similarity",
)
def q_part_type_similarity(spark, sf):
    """C4 on a wider vocabulary: similar spellings among the distinct part types and brands."""
    from ..roles import Roles

    part = spark.read.parquet(f"{sf.rstrip('/')}/part.parquet")
    roles = Roles(key="p_partkey", numeric=(), categorical=("p_type", "p_brand"), target=None)
    return audit.similar_values(part, roles)


@register(
    "schema_issues",
    OD
    + """SELECT 'missing_columns' AS code, 'o_custkey' AS fields
UNION ALL SELECT 'column_order_mismatch', ''
UNION ALL SELECT 'numeric_type_mismatch', 'price_txt'
UNION ALL SELECT * FROM (
  SELECT 'all_null_columns' AS code,
    concat_ws(',', CASE WHEN count(o_orderkey) = 0 THEN 'o_orderkey' END,
                   CASE WHEN count(price_txt) = 0 THEN 'price_txt' END,
                   CASE WHEN count(CASE WHEN NOT isnan(price) THEN price END) = 0 THEN 'price' END,
                   CASE WHEN count(status) = 0 THEN 'status' END,
                   CASE WHEN count(priority) = 0 THEN 'priority' END) AS fields
  FROM orders_dirty) a WHERE fields <> ''""",
)
def q_schema_issues(spark, sf):
    """Missing, extra, order, all-null and numeric-type issues against a declared schema."""
    return audit.schema_issues(_od(spark, sf), SCHEMA_ROLES)


def _issues_sql() -> str:
    cols = ["o_orderkey", "price_txt", "price", "status", "priority"]
    miss = " + ".join(f"count_if({c} IS NULL{' OR isnan(price)' if c == 'price' else ''})" for c in cols)
    all_null = " OR ".join(f"count({c}) = 0" for c in cols)
    parts = [
        f"""SELECT 'schema_invalid' AS code, 'error' AS severity, CAST(NULL AS VARCHAR) AS field, concat_ws(',', a, 'numeric_type_mismatch') AS detail
  FROM (SELECT CASE WHEN {all_null} THEN 'all_null_columns' END AS a FROM orders_dirty) z""",
        f"SELECT 'missing_values', 'warning', NULL, CAST(CAST(m AS BIGINT) AS VARCHAR) FROM (SELECT {miss} AS m FROM orders_dirty) z WHERE m > 0",
        """SELECT 'duplicate_rows', 'warning', NULL, CAST(CAST(d AS BIGINT) AS VARCHAR) FROM (SELECT coalesce(sum(c - 1), 0) AS d FROM (
  SELECT count(*) AS c FROM orders_dirty GROUP BY ALL HAVING true) g) z WHERE d > 0""".replace("GROUP BY ALL HAVING true", "GROUP BY " + ", ".join(cols)),
    ]
    for c, t in OD_NUMERIC:
        x, fin = _sql_num(c, t), _sql_fin(c, t)
        lo, hi = ORDERS_DIRTY.ranges.get(c, (None, None))
        counts = [("negative_count", f"count_if({fin} < 0)")]
        if lo is not None and lo > 0:
            counts.append(("unreasonable_zero_count", f"count_if({fin} = 0)"))
        counts += [("infinite_count", f"count_if(isinf({x}))"), ("non_numeric_count", f"count_if({c} IS NOT NULL AND {x} IS NULL)")]
        if c != "o_orderkey":
            counts.append(("iqr_extreme_count", f"count_if({fin} < q1 - 1.5 * (q3 - q1) OR {fin} > q3 + 1.5 * (q3 - q1))"))
        if lo is not None:
            counts.append(("outside_range_count", f"count_if({fin} < {lo} OR {fin} > {hi})"))
        text = ", ".join(f"CASE WHEN {n} > 0 THEN '{n}=' || CAST({n} AS VARCHAR) END" for n, _ in counts)
        inner = ", ".join(f"{e} AS {n}" for n, e in counts)
        parts.append(
            f"SELECT 'numeric_quality', 'warning', '{c}', d FROM (SELECT concat_ws(',', {text}) AS d FROM (SELECT {inner} FROM orders_dirty, "
            f"(SELECT quantile_cont({fin}, 0.25) AS q1, quantile_cont({fin}, 0.75) AS q3 FROM orders_dirty) q) y) z WHERE d <> ''"
        )
    cat = [
        ("whitespace_count", f"SELECT count_if(status <> {_S}) FROM orders_dirty"), ("empty_string_count", f"SELECT count_if({_S} = '') FROM orders_dirty"),
        ("case_conflicts", f"SELECT count(*) FROM (SELECT lower(v) FROM (SELECT DISTINCT {_S} AS v FROM orders_dirty WHERE status IS NOT NULL AND {_S} <> '') d GROUP BY lower(v) HAVING count(*) > 1) g"),
        ("unexpected_values", "SELECT count(DISTINCT status) FROM orders_dirty WHERE status NOT IN ('F', 'O', 'P')"),
    ]
    text = ", ".join(f"CASE WHEN ({e}) > 0 THEN '{n}=' || CAST(({e}) AS VARCHAR) END" for n, e in cat)
    parts.append(f"SELECT 'categorical_quality', 'warning', 'status', d FROM (SELECT concat_ws(',', {text}) AS d) z WHERE d <> ''")
    parts.append(
        "SELECT 'unexpected_target_values', 'error', 'priority', CAST(n AS VARCHAR) FROM (SELECT count(DISTINCT priority) AS n FROM orders_dirty "
        "WHERE priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) z WHERE n > 0"
    )
    parts.append(
        "SELECT 'target_imbalance', 'warning', 'priority', CAST(round(hi / lo, 6) AS VARCHAR) FROM (SELECT max(n) AS hi, min(n) AS lo FROM "
        "(SELECT count(*) AS n FROM orders_dirty WHERE priority IS NOT NULL GROUP BY priority) c) z WHERE hi / lo >= 1.5"
    )
    return OD + "\nUNION ALL\n".join(parts)


@register("quality_issues", _issues_sql())
def q_quality_issues(spark, sf):
    """The part of ``quality_issues_full`` that SQL can check: all but the similar-spelling rows."""
    return audit.quality_issues(_od(spark, sf), ORDERS_DIRTY, similar=False)


@register("quality_issues_full")
def q_quality_issues_full(spark, sf):
    """The whole issue list (code, severity, field, detail) of the dirty orders."""
    return audit.quality_issues(_od(spark, sf), ORDERS_DIRTY)


@register("similar_issues")
def q_similar_issues(spark, sf):
    """The issue rows that count similar spellings per field."""
    return audit.quality_issues(_od(spark, sf), ORDERS_DIRTY).where("code = 'similar_values'")


@register(
    "overview",
    ML + """SELECT count(*) AS row_count, CAST(4 AS BIGINT) AS feature_count, count(DISTINCT tier) AS class_count FROM ml_orders""",
)
def q_overview(spark, sf):
    """Rows, feature count and class count of the modelling table."""
    return audit.overview(_ml(spark, sf), ML_ORDERS)


def _overview_model_sql() -> str:
    from .queries_eval import RESULTS

    return RESULTS + """SELECT (SELECT count(*) FROM ml_orders) AS row_count, CAST(4 AS BIGINT) AS feature_count, (SELECT count(DISTINCT tier) FROM ml_orders) AS class_count,
  model AS selected_model, val_macro_f1, val_accuracy FROM results ORDER BY val_macro_f1 DESC, val_accuracy DESC, train_s, fixed_order LIMIT 1"""


@register("overview_active", _overview_model_sql())
def q_overview_active(spark, sf):
    """The overview with the model that selection has made active."""
    from ..operators import select
    from .queries_eval import model_results

    return audit.overview(_ml(spark, sf), ML_ORDERS, select.select_model(model_results(spark, sf)))


@register(
    "coerce_numeric",
    OD + f"""SELECT o_orderkey, price_txt, {_sql_num('price_txt', 'string')} AS price_num FROM orders_dirty""",
)
def q_coerce_numeric(spark, sf):
    """Text to number; text that is not a number becomes NULL (Inf spellings kept)."""
    from pyspark.sql import functions as F

    from ..functions.exprs import coerce_double

    df = _od(spark, sf)
    return df.select("o_orderkey", "price_txt", coerce_double(F.col("price_txt"), "string").alias("price_num"))
