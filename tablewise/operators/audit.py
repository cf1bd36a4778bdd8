"""Data-quality audit as distributed aggregations.

Every function takes a DataFrame and its ``Roles`` and returns a tidy, lazy
DataFrame (one row per column, value, class or issue).  Per-column statistics
are computed in one wide aggregation (one pass, partial aggregation, no row
expansion); only the exact quartiles unpivot, through ``orderstats``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import attach_scalars, broadcast_if_small, coerce_double, is_finite, is_inf, strip
from ..functions.similarity import casefold, similar_pairs
from ..roles import Roles
from ..session import checkpoint
from .orderstats import DEFAULT_MAX_SORT_ROWS, quantiles

MISSING = "<MISSING>"
NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _dtype(df: DataFrame, c: str) -> T.DataType:
    return df.schema[c].dataType


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def _missing(df: DataFrame, c: str):
    """pandas-style missing: NULL, or NaN in a floating column."""
    dt = _dtype(df, c)
    col = F.col(c)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row (as literals, no join)."""
    return attach_scalars(df, one_row)


def _long(rows: DataFrame, items: list[tuple[str, list]]) -> DataFrame:
    """Turn a one-row wide result into one row per item via explode (tiny)."""
    structs = [F.struct(F.lit(name).alias("field"), *exprs) for name, exprs in items]
    return rows.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def inferred_numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType)]


def numeric_fields(df: DataFrame, roles: Roles) -> list[str]:
    """Inferred-numeric columns, then declared numeric ones (reference order)."""
    out = inferred_numeric(df)
    for c in roles.numeric:
        if c in df.columns and c not in out:
            out.append(c)
    return out


# ---------------------------------------------------------------- D1 / D14
def dataset_summary(df: DataFrame, roles: Roles) -> DataFrame:
    num = inferred_numeric(df)
    non = [c for c in df.columns if c not in num]
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.lit(",".join(num)).alias("numeric_columns"),
        F.lit(",".join(non)).alias("non_numeric_columns"),
    )


def overview(df: DataFrame, roles: Roles, deployment: DataFrame | None = None) -> DataFrame:
    """Rows, feature count and class count of a dataset, and with ``deployment``
    (the one-row result of model selection) the active model and its scores."""
    out = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(F.col(roles.target)).alias("class_count"),
    ).select("row_count", F.lit(len(roles.features)).cast("long").alias("feature_count"), "class_count")
    return out if deployment is None else with_scalar(out, deployment)


# ---------------------------------------------------------------- B3
def _static_schema_issues(df: DataFrame, roles: Roles) -> list[tuple[str, str]]:
    """Schema issues that the column list and types alone show: (code, fields)."""
    cols, req = list(df.columns), list(roles.required_columns)
    missing = [c for c in req if c not in cols]
    extra = [c for c in cols if c not in req]
    mismatched = [c for c in roles.numeric if c in cols and not is_numeric_type(_dtype(df, c))]
    found = [("missing_columns", missing), ("extra_columns", extra)]
    out = [(code, ",".join(names)) for code, names in found if names]
    if cols != req:
        out.append(("column_order_mismatch", ""))
    if mismatched:
        out.append(("numeric_type_mismatch", ",".join(mismatched)))
    return out


def schema_issues(df: DataFrame, roles: Roles) -> DataFrame:
    """One row per schema issue: missing/extra columns, order, all-null, type.

    Column presence and order come from the schema (driver metadata); the
    all-null check is one aggregation of ``count(c)`` over all columns.
    """
    cols = list(df.columns)
    static = _static_schema_issues(df, roles)
    counts = df.agg(*[F.count(F.when(~_missing(df, c), 1)).alias(f"c{i}") for i, c in enumerate(cols)])
    all_null = F.concat_ws(
        ",", *[F.when(F.col(f"c{i}") == 0, F.lit(c)) for i, c in enumerate(cols)]
    )
    items = [F.struct(F.lit(code).alias("code"), F.lit(fields).alias("fields")) for code, fields in static]
    items.append(F.struct(F.lit("all_null_columns").alias("code"), all_null.alias("fields")))
    out = counts.select(F.explode(F.array(*items)).alias("_r")).select("_r.*")
    return out.where((F.col("code") != "all_null_columns") | (F.col("fields") != ""))


def schema_valid(df: DataFrame, roles: Roles) -> bool:
    issues = {r["code"] for r in schema_issues(df, roles).collect()}
    ok = True
    if "missing_columns" in issues and not roles.allow_missing:
        ok = False
    if "extra_columns" in issues and not roles.allow_extra:
        ok = False
    if "all_null_columns" in issues and not roles.allow_all_null:
        ok = False
    if "numeric_type_mismatch" in issues or "column_order_mismatch" in issues:
        ok = False
    return ok


# ---------------------------------------------------------------- D2 / D3
def _as_text(df: DataFrame, c: str):
    col = F.col(c)
    if isinstance(_dtype(df, c), (T.FloatType, T.DoubleType)):
        col = F.when(~F.isnan(col), col)
    return col.cast("string")


def field_profile(df: DataFrame, roles: Roles | None = None, approx: bool = False) -> DataFrame:
    """Per column: position, dtype, non-null, missing, missing ratio, distinct.

    Counts come from one wide aggregation.  Exact distinct counts unpivot the
    columns to ``(field, value)`` and group on the pair (partial aggregation
    keeps one row per distinct value per task); ``approx=True`` uses HLL++
    in the same single pass instead.
    """
    cols = list(df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count(F.when(_missing(df, c), 1)).alias(f"m{i}") for i, c in enumerate(cols)]
    if approx:
        aggs += [F.approx_count_distinct(_as_text(df, c), 0.01).alias(f"u{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    items = []
    for i, c in enumerate(cols):
        exprs = [
            F.lit(i).cast("long").alias("position"),
            F.lit(_dtype(df, c).simpleString()).alias("dtype"),
            (F.col("_rows") - F.col(f"m{i}")).alias("non_null_count"),
            F.col(f"m{i}").alias("missing_count"),
            F.round(F.coalesce(F.try_divide(F.col(f"m{i}"), F.col("_rows")), F.lit(0.0)), 6).alias("missing_ratio"),
        ]
        if approx:
            exprs.append(F.col(f"u{i}").alias("unique_count"))
        items.append((c, exprs))
    prof = _long(wide, items)
    if approx:
        return prof
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("field"), _as_text(df, c).alias("v")) for c in cols])).alias("_kv")
    ).select("_kv.field", "_kv.v").where(F.col("v").isNotNull())
    distinct = long.distinct().groupBy("field").agg(F.count(F.lit(1)).alias("unique_count"))
    return prof.join(distinct, "field", "left").withColumn(
        "unique_count", F.coalesce(F.col("unique_count"), F.lit(0)).cast("long")
    )


def missing_total(df: DataFrame) -> DataFrame:
    cols = list(df.columns)
    total = reduce(lambda a, b: a + b, [F.count(F.when(_missing(df, c), 1)) for c in cols])
    return df.agg(total.alias("total_missing"), F.count(F.lit(1)).alias("_rows")).select(
        "total_missing",
        F.round(F.coalesce(F.try_divide(F.col("total_missing"), F.col("_rows") * len(cols)), F.lit(0.0)), 6).alias(
            "total_missing_ratio"
        ),
    )


# ---------------------------------------------------------------- D4
def duplicate_groups(df: DataFrame) -> DataFrame:
    """Groups of identical rows (nulls equal) with their multiplicity > 1.

    One pass: a group on the whole row with map-side combination, so the
    copies of one row reach the shuffle once per task.
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("multiplicity")).where(F.col("multiplicity") > 1)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of identical rows, and their ratio."""
    dup = duplicate_groups(df).agg(F.coalesce(F.sum(F.col("multiplicity") - 1), F.lit(0)).cast("long").alias("d"))
    n = df.agg(F.count(F.lit(1)).alias("n"))
    return with_scalar(dup, n).select(
        F.col("d").alias("duplicate_row_count"),
        F.round(F.coalesce(F.try_divide(F.col("d"), F.col("n")), F.lit(0.0)), 6).alias("duplicate_row_ratio"),
    )


# ---------------------------------------------------------------- D5
def value_distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts and ratios per value, missing shown as ``<MISSING>``."""
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("field"),
                        F.coalesce(_as_text(df, c), F.lit(MISSING)).alias("value"),
                    )
                    for c in columns
                ]
            )
        ).alias("_kv")
    ).select("_kv.*")
    counts = long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    return with_scalar(counts, total).select(
        "field", "value", "count", F.round(F.col("count") / F.col("_n"), 6).alias("ratio")
    )


# ---------------------------------------------------------------- D6-D9
def _coerced(df: DataFrame, c: str):
    return coerce_double(c, _dtype(df, c).simpleString())


def _numeric_aggs(df: DataFrame, roles: Roles, fields: list[str]) -> list:
    """Per-column counters and moments as aggregate columns."""
    aggs = []
    for i, c in enumerate(fields):
        x = _coerced(df, c)
        fin = F.when(is_finite(x), x)
        present = ~_missing(df, c)
        lo, hi = roles.ranges.get(c, (None, None))
        aggs += [
            F.count(F.when(present, 1)).alias(f"cnt{i}"),
            F.count(fin).alias(f"fin{i}"),
            F.avg(fin).alias(f"mean{i}"),
            F.stddev_samp(fin).alias(f"std{i}"),
            F.min(fin).alias(f"min{i}"),
            F.max(fin).alias(f"max{i}"),
            F.count(F.when(fin < 0, 1)).alias(f"neg{i}"),
            F.count(F.when(fin == 0, 1)).alias(f"zero{i}"),
            F.count(F.when(is_inf(x), 1)).alias(f"inf{i}"),
            F.count(F.when(present & x.isNull(), 1)).alias(f"nonnum{i}"),
            (F.count(F.when((fin < lo) | (fin > hi), 1)) if lo is not None else F.lit(0).cast("long")).alias(
                f"out{i}"
            ),
        ]
    return aggs


def numeric_profile_wide(df: DataFrame, roles: Roles, fields: list[str]) -> DataFrame:
    """All per-column counters and moments in one pass over the table."""
    return df.agg(*_numeric_aggs(df, roles, fields))


def _finite_long(df: DataFrame, fields: list[str]) -> DataFrame:
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("field"), _coerced(df, c).alias("x")) for c in fields])).alias("_kv")
    ).select("_kv.field", "_kv.x")
    return long.where(is_finite(F.col("x")))


def numeric_quartiles(df: DataFrame, fields: list[str], max_sort_rows: int = DEFAULT_MAX_SORT_ROWS) -> DataFrame:
    fin = _finite_long(df, fields)
    qs = quantiles(fin, ["field"], "x", [0.25, 0.5, 0.75], max_sort_rows)
    return qs.groupBy("field").pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("quantile")).select(
        "field", F.col("`0.25`").alias("q25"), F.col("`0.5`").alias("q50"), F.col("`0.75`").alias("q75")
    )


def numeric_summary(df: DataFrame, roles: Roles, max_sort_rows: int = DEFAULT_MAX_SORT_ROWS) -> DataFrame:
    """describe()-style summary on finite values; ``count`` includes +-Inf."""
    fields = numeric_fields(df, roles)
    wide = numeric_profile_wide(df, roles, fields)
    items = [
        (
            c,
            [
                F.col(f"cnt{i}").alias("count"),
                F.col(f"fin{i}").alias("finite_count"),
                F.round(F.col(f"mean{i}"), 6).alias("mean"),
                F.round(F.col(f"std{i}"), 6).alias("std"),
                F.round(F.col(f"min{i}"), 6).alias("min"),
                F.round(F.col(f"max{i}"), 6).alias("max"),
            ],
        )
        for i, c in enumerate(fields)
    ]
    base = _long(wide, items)
    qs = numeric_quartiles(df, fields, max_sort_rows)
    return base.join(qs, "field", "left").select(
        "field", "count", "finite_count", "mean", "std", "min",
        F.round("q25", 6).alias("q25"), F.round("q50", 6).alias("q50"), F.round("q75", 6).alias("q75"), "max",
    )


def numeric_quality(df: DataFrame, roles: Roles) -> DataFrame:
    """Counters: negative, zero, unreasonable zero, infinite, non-numeric, outside range."""
    fields = numeric_fields(df, roles)
    wide = numeric_profile_wide(df, roles, fields)
    items = []
    for i, c in enumerate(fields):
        lo = roles.ranges.get(c, (None, None))[0]
        unreasonable = F.col(f"zero{i}") if (lo is not None and lo > 0) else F.lit(0).cast("long")
        items.append(
            (
                c,
                [
                    F.col(f"neg{i}").alias("negative_count"),
                    F.col(f"zero{i}").alias("zero_count"),
                    unreasonable.alias("unreasonable_zero_count"),
                    F.col(f"inf{i}").alias("infinite_count"),
                    F.col(f"nonnum{i}").alias("non_numeric_count"),
                    F.col(f"out{i}").alias("outside_range_count"),
                ],
            )
        )
    return _long(wide, items)


def iqr_fields(df: DataFrame, roles: Roles) -> list[str]:
    skip = set(roles.categorical) | set(roles.excluded) | set(roles.iqr_exempt)
    return [c for c in numeric_fields(df, roles) if c not in skip]


def iqr_outliers(df: DataFrame, roles: Roles, max_sort_rows: int = DEFAULT_MAX_SORT_ROWS) -> DataFrame:
    """Tukey fences q1-1.5*iqr, q3+1.5*iqr on finite values and the count outside.

    Pass 1 computes exact quartiles per column; the fences (one row per
    column) are collected and pass 2 counts outliers of all columns in one
    wide aggregation.
    """
    fields = iqr_fields(df, roles)
    spark = df.sparkSession
    schema = "field string, iqr_lower double, iqr_upper double, iqr_extreme_count long"
    if not fields:
        return spark.createDataFrame([], schema)
    qs = numeric_quartiles(df, fields, max_sort_rows).collect()
    fences = {}
    for r in qs:
        if r["q25"] is None or r["q75"] is None:
            continue
        iqr = r["q75"] - r["q25"]
        fences[r["field"]] = (r["q25"] - 1.5 * iqr, r["q75"] + 1.5 * iqr)
    if not fences:
        return spark.createDataFrame([], schema)
    names = [c for c in fields if c in fences]
    aggs = []
    for i, c in enumerate(names):
        x = _coerced(df, c)
        fin = F.when(is_finite(x), x)
        lo, hi = fences[c]
        aggs.append(F.count(F.when((fin < lo) | (fin > hi), 1)).alias(f"e{i}"))
    wide = df.agg(*aggs)
    items = [
        (
            c,
            [
                F.round(F.lit(fences[c][0]), 6).alias("iqr_lower"),
                F.round(F.lit(fences[c][1]), 6).alias("iqr_upper"),
                F.col(f"e{i}").alias("iqr_extreme_count"),
            ],
        )
        for i, c in enumerate(names)
    ]
    return _long(wide, items)


# ---------------------------------------------------------------- D10 / D11 / C2 / C4
def _string_cols(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


def categorical_quality(df: DataFrame, roles: Roles) -> DataFrame:
    """Distinct count, leading/trailing whitespace and blank-string counters."""
    cols = _string_cols(df, roles.categorical)
    aggs = []
    for i, c in enumerate(cols):
        s = F.col(c) if isinstance(_dtype(df, c), T.StringType) else F.lit(None).cast("string")
        aggs += [
            F.count(F.when(s != strip(s), 1)).alias(f"ws{i}"),
            F.count(F.when(strip(s) == "", 1)).alias(f"bl{i}"),
        ]
    wide = df.agg(*aggs)
    items = [(c, [F.col(f"ws{i}").alias("whitespace_count"), F.col(f"bl{i}").alias("empty_string_count")]) for i, c in enumerate(cols)]
    base = _long(wide, items)
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("field"), _as_text(df, c).alias("v")) for c in cols])).alias("_kv")
    ).select("_kv.*").where(F.col("v").isNotNull())
    uniq = long.distinct().groupBy("field").agg(F.count(F.lit(1)).alias("unique_count"))
    return base.join(uniq, "field", "left").select(
        "field",
        F.coalesce("unique_count", F.lit(0)).cast("long").alias("unique_count"),
        "whitespace_count",
        "empty_string_count",
    )


def _distinct_strings(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct stripped non-blank string values per field: ``(field, value)``."""
    parts = []
    for c in cols:
        if not isinstance(_dtype(df, c), T.StringType):
            continue
        parts.append(F.struct(F.lit(c).alias("field"), strip(F.col(c)).alias("value")))
    if not parts:
        return df.sparkSession.createDataFrame([], "field string, value string")
    return (
        df.select(F.explode(F.array(*parts)).alias("_kv"))
        .select("_kv.*")
        .where(F.col("value").isNotNull() & (F.col("value") != ""))
        .distinct()
    )


def case_conflicts(df: DataFrame, roles: Roles) -> DataFrame:
    """Groups of spellings equal after strip + case folding (more than one spelling)."""
    vals = _distinct_strings(df, _string_cols(df, roles.categorical)).withColumn("folded", casefold("value"))
    grouped = vals.groupBy("field", "folded").agg(
        F.count(F.lit(1)).alias("n_spellings"),
        F.array_join(F.sort_array(F.collect_list("value")), "|").alias("spellings"),
    )
    return grouped.where(F.col("n_spellings") > 1)


def _not_allowed(values: DataFrame, df: DataFrame, roles: Roles) -> DataFrame:
    """Rows of distinct (field, value as text) whose field has an allow-list that lacks the value."""
    lists = {c: list(a) for c, a in roles.allowed.items() if c in df.columns}
    if roles.target and roles.allowed_targets and roles.target in df.columns:
        lists[roles.target] = list(roles.allowed_targets)
    # values are compared in the column's own type: 1 allows 1.0 in a double column
    rows = [
        F.struct(F.lit(c).alias("field"), F.lit(a).try_cast(_dtype(df, c)).cast("string").alias("value"))
        for c, allowed in lists.items()
        for a in allowed
    ]
    if not rows:
        return values.limit(0)
    allowed_df = df.sparkSession.range(1).select(F.explode(F.array(*rows)).alias("_r")).select("_r.*").where(F.col("value").isNotNull())
    # The allow-list is a literal of the caller's size (bounded): broadcast it.
    return values.where(F.col("field").isin(list(lists))).join(broadcast_if_small(allowed_df, len(rows)), ["field", "value"], "left_anti")


def unexpected_values(df: DataFrame, roles: Roles) -> DataFrame:
    """Observed values not in a column's allow-list (anti join with the list)."""
    cols = [c for c in dict.fromkeys([*roles.allowed, *([roles.target] if roles.allowed_targets else [])]) if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame([], "field string, value string")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in cols])).alias("_kv")
    observed = df.select(pairs).select("_kv.*").where(F.col("value").isNotNull()).distinct()
    return _not_allowed(observed, df, roles)


def similar_values(df: DataFrame, roles: Roles, threshold: float = 0.8) -> DataFrame:
    """Near-identical spellings among distinct values (ratio >= threshold).

    Pairs of observed values (both legal ones skipped, case-only differences
    skipped) plus observed-vs-allowed pairs for observed values that are not
    legal.  Candidates come from an exact prefix-filter join, never all pairs.
    """
    cols = _string_cols(df, roles.categorical)
    return _similar(_distinct_strings(df, cols), df.sparkSession, roles, cols, threshold)


def _similar(vals: DataFrame, spark, roles: Roles, cols: list[str], threshold: float = 0.8) -> DataFrame:
    """Similar pairs from distinct stripped (field, value) rows."""
    allowed_rows = [(c, str(a)) for c, allowed in roles.allowed.items() if c in cols for a in allowed if isinstance(a, str)]
    allowed_df = spark.createDataFrame(allowed_rows, "field string, value string")
    legal = vals.join(broadcast_if_small(allowed_df, len(allowed_rows)), ["field", "value"], "left_semi").withColumn("_legal", F.lit(True))
    vals = vals.join(legal, ["field", "value"], "left").select(
        "field", "value", F.coalesce("_legal", F.lit(False)).alias("_legal")
    )
    pairs = similar_pairs(vals, "field", "value", threshold)
    observed_pairs = pairs.where(
        ~(F.col("l_legal") & F.col("r_legal"))
        & (F.col("left") < F.col("right"))
        & (casefold("left") != casefold("right"))
    )
    # observed values that are not legal, against every allowed value
    allowed_side = allowed_df.select("field", "value", F.lit(True).alias("_legal"))
    both = vals.where(~F.col("_legal")).select("field", "value", "_legal").unionByName(allowed_side)
    cross = similar_pairs(both, "field", "value", threshold).where(~F.col("l_legal") & F.col("r_legal"))
    out = observed_pairs.select("field", "left", "right", "similarity").unionByName(
        cross.select("field", "left", "right", "similarity")
    )
    return out.distinct()


# ---------------------------------------------------------------- D12
def target_summary(df: DataFrame, roles: Roles) -> DataFrame:
    """Class count, most/least frequent class, max/min ratio, imbalance flag.

    Ties: most frequent = largest count then smallest value; least frequent =
    smallest count then smallest value.
    """
    t = roles.target
    counts = df.where(F.col(t).isNotNull()).groupBy(F.col(t).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    s = counts.agg(
        F.count(F.lit(1)).alias("class_count"),
        F.min_by(F.struct("v", "c"), F.struct(-F.col("c"), F.col("v"))).alias("most"),
        F.min_by(F.struct("v", "c"), F.struct(F.col("c"), F.col("v"))).alias("least"),
    )
    ratio = F.try_divide(F.col("most.c").cast("double"), F.col("least.c"))
    return s.select(
        "class_count",
        F.col("most.v").alias("most_frequent"),
        F.col("most.c").alias("most_count"),
        F.col("least.v").alias("least_frequent"),
        F.col("least.c").alias("least_count"),
        F.round(ratio, 6).alias("max_min_ratio"),
        F.coalesce(ratio >= F.lit(roles.imbalance_warning), F.lit(False)).alias("is_imbalanced"),
    )


# ---------------------------------------------------------------- D13
ISSUE = "code string, severity string, field string, detail string"


def _counts_detail(counts: list[tuple[str, int]]) -> str:
    return ",".join(f"{name}={n}" for name, n in counts if n)


def quality_issues(df: DataFrame, roles: Roles, max_sort_rows: int = DEFAULT_MAX_SORT_ROWS, similar: bool = True) -> DataFrame:
    """Issue list (code, severity, field, detail) of a table.

    The counters of all columns come from one wide aggregation, outlier counts
    from the quartiles and a second one, duplicates from one group, and
    everything about values from one table of distinct (field, value) pairs.
    ``similar`` adds one row per field with near-identical spellings.
    """
    spark = df.sparkSession
    fields = numeric_fields(df, roles)
    cats = _string_cols(df, roles.categorical)
    cols = list(df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows"), *[F.count(F.when(_missing(df, c), 1)).alias(f"_m{i}") for i, c in enumerate(cols)]]
    for i, c in enumerate(cats):
        v = F.col(c) if isinstance(_dtype(df, c), T.StringType) else F.lit(None).cast("string")
        aggs += [F.count(F.when(v != strip(v), 1)).alias(f"_w{i}"), F.count(F.when(strip(v) == "", 1)).alias(f"_b{i}")]
    r = df.agg(*aggs, *_numeric_aggs(df, roles, fields)).first()
    rows: list[tuple] = []

    # schema: only what the roles do not allow
    codes = [code for code, _ in _static_schema_issues(df, roles)]
    if any(r[f"_m{i}"] == r["_rows"] for i in range(len(cols))):
        codes.append("all_null_columns")
    allowed = {"missing_columns": roles.allow_missing, "extra_columns": roles.allow_extra, "all_null_columns": roles.allow_all_null}
    codes = sorted(c for c in codes if not allowed.get(c, False))
    if codes:
        rows.append(("schema_invalid", "error", None, ",".join(codes)))
    missing = sum(r[f"_m{i}"] for i in range(len(cols)))
    if missing:
        rows.append(("missing_values", "warning", None, str(missing)))

    extreme = {x["field"]: x["iqr_extreme_count"] for x in iqr_outliers(df, roles, max_sort_rows).collect()}  # one row per column
    for i, c in enumerate(fields):
        lo = roles.ranges.get(c, (None, None))[0]
        detail = _counts_detail([
            ("negative_count", r[f"neg{i}"]), ("unreasonable_zero_count", r[f"zero{i}"] if lo is not None and lo > 0 else 0),
            ("infinite_count", r[f"inf{i}"]), ("non_numeric_count", r[f"nonnum{i}"]), ("iqr_extreme_count", extreme.get(c, 0)),
            ("outside_range_count", r[f"out{i}"]),
        ])
        if detail:
            rows.append(("numeric_quality", "warning", c, detail))

    # values: one distinct table, checkpointed; counts per field come back
    targets = [roles.target] if roles.target and roles.target in cols else []
    kept = list(dict.fromkeys([*cats, *targets]))
    parts: list[DataFrame] = [duplicate_groups(df).agg(F.sum(F.col("multiplicity") - 1).cast("string").alias("detail")).where(F.col("detail").isNotNull()).select(
        F.lit("duplicate_rows").alias("code"), F.lit("warning").alias("severity"), F.lit(None).cast("string").alias("field"), "detail")]
    if kept:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in kept])).alias("_kv")
        values = checkpoint(df.select(pairs).select("_kv.*").where(F.col("value").isNotNull()).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")))
        texts = [c for c in cats if isinstance(_dtype(df, c), T.StringType)]
        spelled = values.where(F.col("field").isin(texts)).select("field", strip("value").alias("value")).where("value <> ''").distinct()
        conflicts = spelled.withColumn("folded", casefold("value")).groupBy("field", "folded").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
        conflicts = {x["field"]: x["n"] for x in conflicts.groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()}
        odd = _not_allowed(values, df, roles)
        unexpected = {x["field"]: x["n"] for x in odd.groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()}
        for i, c in enumerate(cats):
            detail = _counts_detail([
                ("whitespace_count", r[f"_w{i}"]), ("empty_string_count", r[f"_b{i}"]), ("case_conflicts", conflicts.get(c, 0)),
                ("unexpected_values", unexpected.get(c, 0) if c in roles.allowed else 0),
            ])
            if detail:
                rows.append(("categorical_quality", "warning", c, detail))
        if targets and roles.allowed_targets and unexpected.get(roles.target):
            rows.append(("unexpected_target_values", "error", roles.target, str(unexpected[roles.target])))
        if targets:
            t = values.where(F.col("field") == roles.target).agg(F.max("n").alias("hi"), F.min("n").alias("lo"))
            ratio = F.col("hi") / F.col("lo")
            parts.append(t.where(ratio >= roles.imbalance_warning).select(
                F.lit("target_imbalance").alias("code"), F.lit("warning").alias("severity"), F.lit(roles.target).alias("field"), F.round(ratio, 6).cast("string").alias("detail")))
        if similar:
            near = _similar(spelled, spark, roles, cats).groupBy("field").agg(F.count(F.lit(1)).alias("n"))
            parts.append(near.select(F.lit("similar_values").alias("code"), F.lit("warning").alias("severity"), "field",
                                     F.concat(F.lit("similar_pairs="), F.col("n").cast("string")).alias("detail")))
    return reduce(DataFrame.unionByName, [spark.createDataFrame(rows, ISSUE), *parts])
