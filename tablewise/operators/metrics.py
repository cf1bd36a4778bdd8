"""Multi-class evaluation metrics as aggregations.

Predictions are ``(y, p)`` string columns plus optional group columns (model,
split).  The only shuffle is one ``groupBy(groups, y, p).count()`` with
partial aggregation; everything after works on that k x k cell table, whose
size is bounded by the label set, never by the row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import attach_scalars
from ..session import checkpoint


def _classes_col(classes: list[str]):
    return F.array(*[F.lit(c) for c in classes])


def cell_counts(df: DataFrame, y: str, p: str, by: list[str] | None = None) -> DataFrame:
    by = list(by or [])
    return df.groupBy(*by, F.col(y).cast("string").alias("true_class"), F.col(p).cast("string").alias("pred_class")).agg(
        F.count(F.lit(1)).alias("count")
    )


def confusion_matrix(df: DataFrame, y: str, p: str, classes: list[str], by: list[str] | None = None) -> DataFrame:
    """dense k x k counts over all declared classes (absent pairs count 0).

    The data pass is one partially aggregated count per (group, y, p); that
    cell table is bounded by the label set and checkpointed, so everything
    derived from it never rereads the predictions.
    """
    by = list(by or [])
    cells = cell_counts(df, y, p, by).transform(checkpoint)
    groups = cells.select(*by).distinct() if by else df.sparkSession.range(1).select()
    grid = groups.select(
        *by, F.explode(_classes_col(classes)).alias("true_class")
    ).select(*by, "true_class", F.explode(_classes_col(classes)).alias("pred_class"))
    return grid.join(cells, [*by, "true_class", "pred_class"], "left").select(
        *by, "true_class", "pred_class", F.coalesce("count", F.lit(0)).cast("long").alias("count")
    )


def accuracy(df: DataFrame, y: str, p: str, by: list[str] | None = None) -> DataFrame:
    """share of rows whose prediction equals the truth."""
    by = list(by or [])
    hit = (F.col(y).cast("string") == F.col(p).cast("string")).cast("double")
    return df.groupBy(*by).agg(F.round(F.avg(hit), 6).alias("accuracy"))


def per_class(df: DataFrame, y: str, p: str, classes: list[str], by: list[str] | None = None) -> DataFrame:
    """Unrounded per-class precision, recall, f1, support (zero division -> 0)."""
    by = list(by or [])
    return _per_class_from_cm(confusion_matrix(df, y, p, classes, by), by)


def _per_class_from_cm(cm: DataFrame, by: list[str]) -> DataFrame:
    tp = cm.where(F.col("true_class") == F.col("pred_class")).select(*by, F.col("true_class").alias("class"), F.col("count").alias("tp"))
    support = cm.groupBy(*by, F.col("true_class").alias("class")).agg(F.sum("count").alias("support"))
    predicted = cm.groupBy(*by, F.col("pred_class").alias("class")).agg(F.sum("count").alias("predicted"))
    t = tp.join(support, [*by, "class"]).join(predicted, [*by, "class"])
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    t = t.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return t.withColumn("f1", f1).select(*by, "class", "precision", "recall", "f1", F.col("support").cast("long").alias("support"))


def classification_report(df: DataFrame, y: str, p: str, classes: list[str], by: list[str] | None = None) -> DataFrame:
    """per-class precision, recall, F1 and support."""
    by = list(by or [])
    t = per_class(df, y, p, classes, by)
    return t.select(*by, "class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


def macro_metrics(df: DataFrame, y: str, p: str, classes: list[str], by: list[str] | None = None) -> DataFrame:
    """unweighted means over all declared classes (absent classes count 0)."""
    by = list(by or [])
    t = per_class(df, y, p, classes, by)
    return t.groupBy(*by).agg(
        F.round(F.avg("precision"), 6).alias("macro_precision"),
        F.round(F.avg("recall"), 6).alias("macro_recall"),
        F.round(F.avg("f1"), 6).alias("macro_f1"),
    )


def weighted_metrics(df: DataFrame, y: str, p: str, classes: list[str], by: list[str] | None = None) -> DataFrame:
    """support-weighted means."""
    by = list(by or [])
    t = per_class(df, y, p, classes, by)

    def w(c):
        return F.round(F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")), F.lit(0.0)), 6)

    return t.groupBy(*by).agg(w("precision").alias("weighted_precision"), w("recall").alias("weighted_recall"), w("f1").alias("weighted_f1"))


def report_table(df: DataFrame, y: str, p: str, classes: list[str]) -> DataFrame:
    """class rows plus 'macro avg' and 'weighted avg' rows."""
    t = per_class(df, y, p, classes)
    total = F.sum("support")
    macro = t.agg(
        F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"), total.alias("support"),
    )
    weighted = t.agg(
        F.lit("weighted avg").alias("class"),
        *[F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), total), F.lit(0.0)).alias(c) for c in ("precision", "recall", "f1")],
        total.alias("support"),
    )
    out = t.select("class", "precision", "recall", "f1", "support").unionByName(macro).unionByName(weighted)
    return out.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], F.col("support").cast("long").alias("support"))


def largest_confusion(df: DataFrame, y: str, p: str, classes: list[str]) -> DataFrame:
    """the most frequent off-diagonal cell (first in row-major class order on ties)."""
    cm = confusion_matrix(df, y, p, classes)
    pos = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(i))])
    off = cm.where(F.col("true_class") != F.col("pred_class"))
    best = off.agg(
        F.min_by(F.struct("true_class", "pred_class", "count"), F.struct(-F.col("count"), pos[F.col("true_class")], pos[F.col("pred_class")])).alias("b")
    )
    return best.select("b.true_class", "b.pred_class", "b.count")


def log_loss(df: DataFrame, probs: list[str], label_index: str, weights_sq_sum: float = 0.0, l2: float = 0.0) -> DataFrame:
    """mean cross-entropy with p clipped to [1e-12, 1], plus 0.5*l2*sum(w^2).

    ``probs`` are the class probability columns in class order and
    ``label_index`` the 0-based true class.  The penalty term needs the model
    weights, which live on the driver, so it is passed in as a number.
    """
    arr = F.array(*[F.col(c).cast("double") for c in probs])
    picked = F.element_at(arr, F.col(label_index).cast("int") + 1)
    clipped = F.least(F.greatest(picked, F.lit(1e-12)), F.lit(1.0))
    return df.agg((-F.avg(F.ln(clipped)) + F.lit(0.5 * l2 * weights_sq_sum)).alias("_l")).select(F.round("_l", 6).alias("log_loss"))


def evaluate(df: DataFrame, y: str, p: str, classes: list[str], by: list[str] | None = None) -> DataFrame:
    """Accuracy, macro and weighted metrics per group in one table (one data pass)."""
    by = list(by or [])
    cm = confusion_matrix(df, y, p, classes, by)  # built from checkpointed cells
    acc = cm.groupBy(*by).agg(
        F.round(F.try_divide(F.sum(F.when(F.col("true_class") == F.col("pred_class"), F.col("count"))).cast("double"), F.sum("count")), 6).alias("accuracy")
    )
    pc = _per_class_from_cm(cm, by)
    mac = pc.groupBy(*by).agg(
        F.round(F.avg("precision"), 6).alias("macro_precision"),
        F.round(F.avg("recall"), 6).alias("macro_recall"),
        F.round(F.avg("f1"), 6).alias("macro_f1"),
    )

    def w(c):
        return F.round(F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")), F.lit(0.0)), 6)

    wei = pc.groupBy(*by).agg(w("precision").alias("weighted_precision"), w("recall").alias("weighted_recall"), w("f1").alias("weighted_f1"))
    if not by:
        return attach_scalars(attach_scalars(acc, mac), wei)
    return acc.join(mac, by).join(wei, by)
