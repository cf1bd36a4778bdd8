"""Model comparison, selection and epoch bookkeeping.

Inputs are small result tables (one row per model, candidate or epoch), so
the global windows used for ranking are over a handful of rows.  The test
metrics only rank; the deployment choice reads validation metrics only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from ..functions.exprs import broadcast_if_small


def select_model(results: DataFrame) -> DataFrame:
    """The deployment choice: validation macro-F1 desc, validation accuracy
    desc, training time asc, fixed order asc.  Test metrics are not read."""
    order = F.struct(-F.col("val_macro_f1"), -F.col("val_accuracy"), F.col("train_s"), F.col("fixed_order"))
    return results.agg(F.min_by(F.struct("model", "val_macro_f1", "val_accuracy"), order).alias("s")).select(
        F.col("s.model").alias("selected_model"), F.col("s.val_macro_f1").alias("val_macro_f1"), F.col("s.val_accuracy").alias("val_accuracy")
    )


def model_ranking(results: DataFrame) -> DataFrame:
    """Rank by test macro-F1 desc, test accuracy desc, name asc, with the
    deployment flag from ``select_model``."""
    w = Window.orderBy(F.col("test_macro_f1").desc(), F.col("test_accuracy").desc(), F.col("model").asc())
    chosen = select_model(results).select(F.col("selected_model").alias("model"), F.lit(True).alias("_sel"))
    ranked = results.withColumn("rank", F.row_number().over(w))
    return ranked.join(broadcast_if_small(chosen, 1), "model", "left").select(
        "rank", "model", "val_macro_f1", "val_accuracy", "test_macro_f1", "test_accuracy", "train_s",
        F.coalesce("_sel", F.lit(False)).alias("selected_for_deployment"),
    )


def select_candidate(candidates: DataFrame, family: str = "family") -> DataFrame:
    """Best candidate per model family: macro-F1 desc, accuracy desc, time asc, index asc."""
    w = Window.partitionBy(family).orderBy(
        F.col("val_macro_f1").desc(), F.col("val_accuracy").desc(), F.col("train_s").asc(), F.col("candidate_index").asc()
    )
    return candidates.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def best_epoch(epochs: DataFrame) -> DataFrame:
    """First epoch with the minimum validation loss; else first maximum of the
    validation score; else minimum train loss.  Early stop = epochs run < configured."""
    g = epochs.groupBy("model").agg(
        F.count(F.col("val_loss")).alias("_nvl"),
        F.count(F.col("val_score")).alias("_nvs"),
        F.count(F.lit(1)).alias("trained_epochs"),
        F.max("max_epochs").alias("_mx"),
    )
    e = epochs.join(g, "model")
    metric = (
        F.when(F.col("_nvl") > 0, F.col("val_loss"))
        .when(F.col("_nvs") > 0, -F.col("val_score"))
        .otherwise(F.col("train_loss"))
    )
    e = e.withColumn("_m", metric).where(F.col("_m").isNotNull())
    w = Window.partitionBy("model").orderBy(F.col("_m").asc(), F.col("epoch").asc())
    best = e.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
    return best.select(
        "model",
        F.col("epoch").alias("best_epoch"),
        F.when(F.col("_nvl") > 0, "val_loss").when(F.col("_nvs") > 0, "val_score").otherwise("train_loss").alias("criterion"),
        "trained_epochs",
        (F.col("trained_epochs") < F.col("_mx")).alias("early_stopped"),
    )


def ranked_probabilities(df: DataFrame, key: str, prob_cols: list[str], classes: list[str]) -> DataFrame:
    """Each row's classes ranked by probability (desc; class order on ties).

    Sorting happens inside each row's array, so there is no shuffle.
    """
    arr = F.array(*[F.struct((-F.col(c).cast("double")).alias("neg"), F.lit(i).alias("idx"), F.lit(cls).alias("class"), F.col(c).cast("double").alias("p"))
                    for i, (c, cls) in enumerate(zip(prob_cols, classes))])
    return df.select(key, F.posexplode(F.array_sort(arr)).alias("_pos", "_s")).select(
        key, (F.col("_pos") + 1).alias("rank"), F.col("_s.class").alias("class"), F.round(F.col("_s.p"), 6).alias("probability")
    )
