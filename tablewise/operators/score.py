"""Input validation, probability checks and prediction assembly.

All row rules are column expressions evaluated in one projection (no shuffle);
each row gets the ordered list of the rules it breaks.  ``strict`` mode
rejects a batch with the first failing rule, as the reference does;
``quarantine`` mode keeps the batch and returns valid and rejected rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import coerce_double, is_finite, strip


@dataclass(frozen=True)
class InputMetadata:
    """What a scoring input must look like: columns, numeric ranges, category options."""

    input_columns: tuple[str, ...]
    numeric_columns: tuple[str, ...]
    categorical_columns: tuple[str, ...]
    numeric_ranges: dict = field(default_factory=dict)  # col -> (min, max, source)
    categorical_options: dict = field(default_factory=dict)  # col -> tuple of options


class ValidationError(ValueError):
    pass


def input_metadata(train: DataFrame, numeric: list[str], categorical: list[str], configured: dict | None = None) -> DataFrame:
    """Numeric range per column (configured, else train min/max) and the sorted
    category options from the train rows.  One aggregation; output one row per column."""
    configured = configured or {}
    aggs = []
    for i, c in enumerate(numeric):
        aggs += [F.min(F.col(c).cast("double")).alias(f"lo{i}"), F.max(F.col(c).cast("double")).alias(f"hi{i}")]
    wide = train.agg(*aggs) if aggs else train.limit(1).select()
    if categorical:
        # distinct values first (partial aggregation); each column's group then holds
        # only its distinct categories
        long = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).cast("string").alias("v"))
                                                for c in categorical])).alias("_kv")).select("_kv.*").where(F.col("v").isNotNull())
        opts = long.distinct().groupBy("f").agg(F.array_sort(F.collect_list("v")).alias("o")).collect()
        got = {r["f"]: r["o"] for r in opts}
        wide = wide.select("*", *[F.array(*[F.lit(v) for v in got.get(c, [])]).cast("array<string>").alias(f"op{j}") for j, c in enumerate(categorical)])
    items = []
    for i, c in enumerate(numeric):
        if c in configured:
            lo, hi = configured[c]
            items.append(F.struct(F.lit(c).alias("field"), F.lit("numeric").alias("kind"), F.lit(float(lo)).alias("minimum"),
                                  F.lit(float(hi)).alias("maximum"), F.lit("schema_config").alias("source"), F.lit(None).cast("array<string>").alias("options")))
        else:
            items.append(F.struct(F.lit(c).alias("field"), F.lit("numeric").alias("kind"), F.col(f"lo{i}").alias("minimum"),
                                  F.col(f"hi{i}").alias("maximum"), F.lit("training_data").alias("source"), F.lit(None).cast("array<string>").alias("options")))
    for j, c in enumerate(categorical):
        items.append(F.struct(F.lit(c).alias("field"), F.lit("categorical").alias("kind"), F.lit(None).cast("double").alias("minimum"),
                              F.lit(None).cast("double").alias("maximum"), F.lit("training_data").alias("source"), F.col(f"op{j}").alias("options")))
    return wide.select(F.explode(F.array(*items)).alias("_r")).select("_r.*")


def metadata_from_table(meta: DataFrame, numeric: list[str], categorical: list[str]) -> InputMetadata:
    """Collect the (one row per column) metadata table into the driver-side contract."""
    rows = {r["field"]: r for r in meta.collect()}
    ranges = {c: (rows[c]["minimum"], rows[c]["maximum"], rows[c]["source"]) for c in numeric}
    options = {c: tuple(rows[c]["options"] or ()) for c in categorical}
    return InputMetadata(tuple([*numeric, *categorical]), tuple(numeric), tuple(categorical), ranges, options)


def check_columns(df: DataFrame, meta: InputMetadata, key: str | None = None) -> list[str]:
    """Schema-level rules, evaluated on the driver: missing and unknown columns, and
    columns for which the metadata has no range or no options.  ``key`` names the
    row key, which is no input."""
    issues = []
    missing = [c for c in meta.input_columns if c not in df.columns]
    if missing:
        issues.append("missing_columns:" + ",".join(missing))
    unknown = [c for c in df.columns if c not in meta.input_columns and c != key]
    if unknown:
        issues.append("unknown_columns:" + ",".join(unknown))
    no_range = [c for c in meta.numeric_columns if c not in meta.numeric_ranges or None in meta.numeric_ranges[c][:2]]
    if no_range:
        issues.append("missing_range:" + ",".join(no_range))
    no_options = [c for c in meta.categorical_columns if not meta.categorical_options.get(c)]
    if no_options:
        issues.append("missing_options:" + ",".join(no_options))
    return issues


def require_columns(df: DataFrame, meta: InputMetadata, key: str | None = None) -> None:
    issues = check_columns(df, meta, key)
    if issues:
        raise ValidationError("; ".join(issues))


def rule_errors(df: DataFrame, meta: InputMetadata):
    """Ordered error codes per row: missing value, non-numeric/non-finite,
    out of range, invalid option.  Returns an array<string> column."""
    codes = []
    for c in meta.input_columns:
        col = F.col(c)
        blank = col.isNull()
        if isinstance(df.schema[c].dataType, T.StringType):
            blank = blank | (strip(col) == "")
        codes.append(F.when(blank, F.lit(f"missing:{c}")))
    for c in meta.numeric_columns:
        x = coerce_double(F.col(c), df.schema[c].dataType.simpleString())
        present = F.col(c).isNotNull()
        codes.append(F.when(present & ~is_finite(x), F.lit(f"non_numeric:{c}")))
        lo, hi, _ = meta.numeric_ranges[c]
        codes.append(F.when(is_finite(x) & ((x < F.lit(lo)) | (x > F.lit(hi))), F.lit(f"out_of_range:{c}")))
    for c in meta.categorical_columns:
        opts = list(meta.categorical_options[c])
        codes.append(F.when(F.col(c).isNotNull() & ~F.col(c).cast("string").isin(*opts), F.lit(f"invalid_option:{c}")))
    return F.array_compact(F.array(*codes))


def validate_records(df: DataFrame, key: str, meta: InputMetadata) -> DataFrame:
    """Per row ``errors`` (comma-joined, in rule order) and ``is_valid``."""
    require_columns(df, meta, key)
    errs = rule_errors(df, meta)
    return df.select(key, F.array_join(errs, ",").alias("errors"), (F.size(errs) == 0).alias("is_valid"))


def rejected_by_rule(df: DataFrame, key: str, meta: InputMetadata) -> DataFrame:
    """Number of rows breaking each (rule, field)."""
    require_columns(df, meta, key)
    errs = rule_errors(df, meta)
    exploded = df.select(F.explode(errs).alias("e"))
    parts = F.split(F.col("e"), ":", 2)
    return exploded.groupBy(parts.getItem(0).alias("rule"), parts.getItem(1).alias("field")).agg(F.count(F.lit(1)).alias("rejected_rows"))


def split_valid(df: DataFrame, key: str, meta: InputMetadata, mode: str = "quarantine"):
    """Quarantine: (valid rows, rejected rows with errors).  Strict: raise on any rejection or on no rows."""
    require_columns(df, meta, key)
    errs = rule_errors(df, meta)
    tagged = df.withColumn("errors", errs)
    if mode == "strict":
        if df.isEmpty():
            raise ValidationError("input rejected: no rows")
        first = tagged.where(F.size("errors") > 0).select(F.col("errors")[0]).limit(1).collect()
        if first:
            raise ValidationError(f"input rejected: {first[0][0]}")
        return tagged.drop("errors"), None
    return tagged.where(F.size("errors") == 0).drop("errors"), tagged.where(F.size("errors") > 0)


# A row sum is close to 1 within the absolute plus the relative tolerance.
ATOL, RTOL = 1e-6, 1e-5


def violations(arr, n_classes: int | None = None):
    """Codes of the rules that an array of probabilities breaks (array column):
    wrong number of classes, non-finite, outside [0, 1], row sum not close to 1."""
    nonfinite = F.exists(arr, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    out_of_range = F.exists(arr, lambda v: (v < 0) | (v > 1))
    total = F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)
    bad_sum = F.abs(total - F.lit(1.0)) > F.lit(ATOL + RTOL)
    shape = F.lit(False) if n_classes is None else F.coalesce(F.size(arr) != n_classes, F.lit(True)) | arr.isNull()
    return F.array_compact(
        F.array(
            F.when(shape, F.lit("class_count")),
            F.when(nonfinite, F.lit("non_finite")),
            F.when(~nonfinite & out_of_range, F.lit("out_of_range")),
            F.when(~nonfinite & bad_sum, F.lit("row_sum")),
        )
    )


def probability_violations(df: DataFrame, key: str, prob_cols: list[str]) -> DataFrame:
    """``(key, violation)`` rows of a probability matrix held in columns."""
    arr = F.array(*[F.col(c).cast("double") for c in prob_cols])
    return df.select(key, F.explode(violations(arr)).alias("violation"))


def check_probabilities(probs: DataFrame, inputs: DataFrame, key: str, n_classes: int, col: str = "probability") -> None:
    """Raise unless every input row has one row of ``n_classes`` valid probabilities."""
    v = violations(F.col(col), n_classes)
    r = probs.agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.size(v) > 0, v[0])).alias("bad")).first()
    if r["bad"] is not None:
        raise ValidationError(f"probabilities rejected: {r['bad']}")
    rows = inputs.count()
    if r["n"] != rows:
        raise ValidationError(f"probabilities rejected: row_count {r['n']} of {rows}")


def assemble_predictions(df: DataFrame, key: str, prob_cols: list[str] | str, classes: list[str], model_name: str | None = None) -> DataFrame:
    """Argmax class (first maximum), highest probability, class->probability map.

    ``prob_cols`` are the probability columns, or the name of one array column."""
    arr = F.array(*[F.col(c).cast("double") for c in prob_cols]) if not isinstance(prob_cols, str) else F.col(prob_cols)
    idx = F.array_position(arr, F.array_max(arr))
    cls = F.element_at(F.array(*[F.lit(c) for c in classes]), idx.cast("int"))
    out = df.select(
        key,
        cls.alias("predicted_class"),
        F.round(F.array_max(arr), 6).alias("highest_probability"),
        F.map_from_arrays(F.array(*[F.lit(c) for c in classes]), arr).alias("probabilities"),
    )
    if model_name is not None:
        out = out.withColumn("model_name", F.lit(model_name))
    return out
