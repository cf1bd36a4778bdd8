"""Cleaning and exact seeded stratified splitting.

The split reproduces the reference's per-class quotas exactly (largest
remainder, as sklearn's stratified shuffle split) and picks rows per class by
a seeded md5 order.  Instead of a ``row_number`` window over each class, which
would put a class holding a third of the table into one task, the per-class
cut points are found with the distributed exact order statistic, and every
row is then labelled by comparing its hash with its class's cut points: a
broadcast of one row per class and a narrow projection, no sort of the data.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import attach_scalars, blank_to_null, coerce_double, finite_or_null
from ..roles import Roles
from .audit import schema_issues
from .orderstats import DEFAULT_MAX_SORT_ROWS, order_statistics
from ..session import checkpoint
from ..functions.exprs import broadcast_if_small

SPLITS = ("train", "validation", "test")


class SchemaError(ValueError):
    pass


class TargetMissingError(ValueError):
    pass


# ---------------------------------------------------------------- B1-B8
def strip_column_names(df: DataFrame) -> DataFrame:
    """B1: strip whitespace around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def _require_valid(df: DataFrame, roles: Roles) -> None:
    codes = {r["code"]: r["fields"] for r in schema_issues(df, roles).collect()}
    blocking = []
    for code, fields in codes.items():
        if code == "missing_columns" and roles.allow_missing:
            continue
        if code == "extra_columns" and roles.allow_extra:
            continue
        if code == "all_null_columns" and roles.allow_all_null:
            continue
        blocking.append(f"{code}:{fields}")
    if blocking:
        raise SchemaError("schema check failed: " + "; ".join(blocking))


def deduplicate(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (nulls equal); identical rows make 'first' immaterial."""
    return df.dropDuplicates()


def clean(df: DataFrame, roles: Roles, validate: bool = True, strict_target: bool = True) -> DataFrame:
    """Strip names, check schema, drop duplicates (before stripping values),
    coerce numeric columns (bad text and +-Inf -> NULL), strip string categories
    and target (blank -> NULL).  A missing target raises when ``strict_target``;
    otherwise those rows are dropped (see ``target_missing`` for the quarantine).
    """
    df = strip_column_names(df)
    if validate:
        _require_valid(df, roles)
    out = deduplicate(df)
    cols = []
    for f in out.schema.fields:
        c = f.name
        if c in roles.numeric:
            cols.append(finite_or_null(coerce_double(F.col(c), f.dataType.simpleString())).alias(c))
        elif (c in roles.categorical or c == roles.target) and isinstance(f.dataType, T.StringType):
            cols.append(blank_to_null(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    out = out.select(*cols)
    if roles.target:
        if strict_target:
            missing = out.where(F.col(roles.target).isNull()).limit(1).count()
            if missing:
                raise TargetMissingError(f"target column {roles.target} has missing values")
        else:
            out = out.where(F.col(roles.target).isNotNull())
    return out


def target_missing(df: DataFrame, roles: Roles) -> DataFrame:
    """B7 quarantine: rows whose target is missing after stripping (key, raw target)."""
    t = roles.target
    raw = df.select(roles.key, F.col(t).alias("raw_target"))
    dtype = df.schema[t].dataType
    cleaned = blank_to_null(F.col("raw_target")) if isinstance(dtype, T.StringType) else F.col("raw_target")
    return raw.where(cleaned.isNull())


def clean_summary(df: DataFrame, roles: Roles) -> DataFrame:
    """Rows before/after, duplicates removed, outliers removed (always 0)."""
    before = df.agg(F.count(F.lit(1)).alias("rows_before"))
    after = clean(df, roles, validate=False, strict_target=False).agg(F.count(F.lit(1)).alias("rows_after"))
    out = attach_scalars(attach_scalars(attach_scalars(before, after), df.agg(F.count(F.lit(1)).alias("_n"))),
                         deduplicate(df).agg(F.count(F.lit(1)).alias("_d")))
    return out.select(
        "rows_before",
        "rows_after",
        (F.col("_n") - F.col("_d")).alias("duplicate_rows_removed"),
        F.lit(0).cast("long").alias("numeric_outliers_removed"),
    )


# ---------------------------------------------------------------- G1 quotas
def approximate_mode(counts: dict, draws: int) -> dict:
    """Per-class draws proportional to class counts summing exactly to ``draws``.

    Largest-remainder allocation; ties in the remainder go to the smaller
    label (the reference breaks them at random).
    """
    total = sum(counts.values())
    if total == 0:
        return {k: 0 for k in counts}
    cont = {k: v / total * draws for k, v in counts.items()}
    base = {k: int(math.floor(x)) for k, x in cont.items()}
    need = draws - sum(base.values())
    order = sorted(counts, key=lambda k: (-(cont[k] - base[k]), k))
    for k in order[:need]:
        base[k] += 1
    return base


def split_quotas(class_counts: dict, fractions=(0.70, 0.15, 0.15)) -> dict:
    """Exact per-class (train, validation, test) sizes for a two-stage split."""
    tr, va, te = fractions
    n = sum(class_counts.values())
    n_train = int(math.floor(tr * n))
    q_train = approximate_mode(class_counts, n_train)
    rem = {k: class_counts[k] - q_train[k] for k in class_counts}
    share = va / (va + te)
    n_val = int(math.floor(share * sum(rem.values())))
    q_val = approximate_mode(rem, n_val)
    return {k: (q_train[k], q_val[k], class_counts[k] - q_train[k] - q_val[k]) for k in class_counts}


def seeded_hash(key: str, seed: int):
    """60-bit integer prefix of md5('seed:key'): same order as the hex digest."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    fractions=(0.70, 0.15, 0.15),
    seed: int = 42,
    max_sort_rows: int = DEFAULT_MAX_SORT_ROWS,
) -> DataFrame:
    """G1: add a ``split`` column (train / validation / test), exact per-class quotas.

    Rows of each class are ordered by (md5 hash, key); the first q_train go to
    train, the next q_val to validation, the rest to test.
    """
    spark = df.sparkSession
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # one row per class
    if any(k is None for k in counts):
        raise TargetMissingError(f"split label {label} has missing values")
    quotas = split_quotas(counts, fractions)
    qrows = [(k, counts[k], q[0], q[0] + q[1]) for k, q in quotas.items()]
    label_type = df.schema[label].dataType.simpleString()
    qdf = spark.createDataFrame(qrows, f"_lab {label_type}, _n long, _a long, _b long")
    # the narrow (label, key, hash) rows serve every fitting pass; the input itself is read once more, for the labels
    hashed = checkpoint(df.select(F.col(label), F.col(key).alias("_k"), seeded_hash(key, seed).alias("_h")))
    targets = qdf.select(F.col("_lab").alias(label), "_n", F.explode(F.array(F.col("_a") - 1, F.col("_b") - 1)).alias("_rank"))
    targets = targets.where(F.col("_rank") >= 0).distinct()
    stats = order_statistics(hashed, [label], "_h", targets, max_sort_rows).collect()  # two rows per class
    cut = {(r[label], r["_rank"]): (r["_value"], r["_below"]) for r in stats}
    # a cut is the (hash, key) of the last row before it; hashes are 60 bits, so few rows share a cut's hash
    points = [(lab, q - 1, *cut[(lab, q - 1)]) for lab, _, a, b in qrows for q in dict.fromkeys((a, b)) if q > 0]
    at = spark.createDataFrame(points, f"_lab {label_type}, _rank long, _cut long, _below long")
    w = Window.partitionBy("_lab", "_rank").orderBy("_k")
    ties = hashed.join(broadcast_if_small(at, len(points)), (F.col(label) == F.col("_lab")) & (F.col("_h") == F.col("_cut")))
    last = (
        ties.withColumn("_at", F.row_number().over(w) - 1 + F.col("_below")).where(F.col("_at") == F.col("_rank")).select("_lab", "_rank", "_k").collect()
    )
    key_of = {(r["_lab"], r["_rank"]): r["_k"] for r in last}
    key_type = df.schema[key].dataType.simpleString()

    def point(lab, q):
        return (cut[(lab, q - 1)][0], key_of[(lab, q - 1)]) if q > 0 else (None, None)

    cuts = spark.createDataFrame(
        [(lab, *point(lab, a), *point(lab, b)) for lab, _, a, b in qrows],
        f"_lab {label_type}, _t1 long, _k1 {key_type}, _t2 long, _k2 {key_type}",
    )
    h = F.col("_h")

    def upto(t, k):
        return F.coalesce((h < F.col(t)) | ((h == F.col(t)) & (F.col(key) <= F.col(k))), F.lit(False))

    placed = df.withColumn("_h", seeded_hash(key, seed)).join(broadcast_if_small(cuts, len(qrows)), F.col(label) == F.col("_lab"))
    split = F.when(upto("_t1", "_k1"), "train").when(upto("_t2", "_k2"), "validation").otherwise("test")
    return placed.withColumn("split", split).select(*df.columns, "split")


def split_select(df_with_split: DataFrame, split: str) -> DataFrame:
    """Rows of one split (a filter on the split column; semi join when splits are a separate table)."""
    return df_with_split.where(F.col("split") == split).drop("split")


def split_overlap(df_with_split: DataFrame, key: str) -> DataFrame:
    """Split checks: keys in more than one split, rows without a split, sizes."""
    per_key = df_with_split.groupBy(key).agg(F.count_distinct("split").alias("_k"), F.count(F.col("split")).alias("_c"))
    checks = per_key.agg(
        F.count(F.when(F.col("_k") > 1, 1)).alias("overlapping_keys"),
        F.count(F.when(F.col("_c") == 0, 1)).alias("unassigned_keys"),
    )
    sizes = df_with_split.agg(
        *[F.count(F.when(F.col("split") == s, 1)).alias(f"{s}_rows") for s in SPLITS], F.count(F.lit(1)).alias("total_rows")
    )
    return attach_scalars(checks, sizes)


def split_class_distribution(df_with_split: DataFrame, label: str, classes: list[str] | None = None) -> DataFrame:
    """F8: per split sample count and per-class count / ratio over the dense class grid."""
    spark = df_with_split.sparkSession
    cells = df_with_split.groupBy("split", F.col(label).cast("string").alias("class")).agg(F.count(F.lit(1)).alias("count"))
    if classes is None:
        cls = cells.select("class").distinct()
    else:
        cls = spark.createDataFrame([(c,) for c in classes], "class string")
    # grid = 3 splits x k classes (k = label set size), built by explode
    grid = cls.select("class", F.explode(F.array(*[F.lit(s) for s in SPLITS])).alias("split"))
    totals = cells.groupBy("split").agg(F.sum("count").alias("sample_count"))
    out = grid.join(cells, ["split", "class"], "left").join(totals, "split", "left").fillna(0, ["count", "sample_count"])
    return out.select(
        "split", "class", F.col("count").cast("long").alias("count"), F.col("sample_count").cast("long").alias("sample_count"),
        F.round(F.coalesce(F.try_divide(F.col("count"), F.col("sample_count")), F.lit(0.0)), 6).alias("ratio"),
    )


def unseen_labels(df_with_split: DataFrame, label: str) -> DataFrame:
    """Classes present in the data but absent from the train split (anti join)."""
    all_cls = df_with_split.select(F.col(label).alias("class")).distinct()
    train_cls = df_with_split.where(F.col("split") == "train").select(F.col(label).alias("class")).distinct()
    return all_cls.join(train_cls, "class", "left_anti")
