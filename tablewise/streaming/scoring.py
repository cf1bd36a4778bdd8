"""Structured Streaming validation and scoring.

Validation rules, the fitted feature transform and an MLlib model are all
stateless per row, so the batch code applies unchanged to a streaming
DataFrame.  ``stream_score`` writes valid scored rows and rejected rows (with
their rule codes) to two file sinks with their own checkpoints -- exactly
once per file, restartable after a failure.  ``stream_rule_counts`` keeps a
running count of rejections per rule (stateful aggregation, complete mode)
and materialises each version with ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.features import FittedFeatures
from ..operators.score import InputMetadata, require_columns, rule_errors


def read_stream(spark: SparkSession, source_dir: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """File stream; ``files_per_trigger`` bounds a micro-batch (none by default: all files there are)."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(source_dir)


def scored_stream(stream: DataFrame, key: str, meta: InputMetadata, fitted: FittedFeatures, model) -> tuple[DataFrame, DataFrame]:
    """(scored valid rows, rejected rows) of a streaming input."""
    require_columns(stream, meta, key)
    tagged = stream.withColumn("errors", rule_errors(stream, meta))
    valid = tagged.where(F.size("errors") == 0).drop("errors")
    rejected = tagged.where(F.size("errors") > 0).select(key, F.array_join("errors", ",").alias("errors"))
    X = fitted.transform(valid, keep=[key])
    pred = model.transform(X).select(key, vector_to_array("probability").alias("p"))
    names = F.array(*[F.lit(c) for c in fitted.classes])
    out = pred.select(
        key,
        F.element_at(names, F.array_position("p", F.array_max("p")).cast("int")).alias("predicted_class"),
        F.round(F.array_max("p"), 6).alias("highest_probability"),
    )
    return out, rejected


def stream_score(spark: SparkSession, source_dir: str, schema: T.StructType, key: str, meta: InputMetadata,
                 fitted: FittedFeatures, model, out_dir: str) -> tuple[str, str]:
    """Run the scoring stream over everything available now; returns the sink paths."""
    stream = read_stream(spark, source_dir, schema)
    scored, rejected = scored_stream(stream, key, meta, fitted, model)
    q1 = (scored.writeStream.format("parquet").option("path", f"{out_dir}/scored")
          .option("checkpointLocation", f"{out_dir}/_ckpt_scored").trigger(availableNow=True).start())
    q2 = (rejected.writeStream.format("parquet").option("path", f"{out_dir}/rejected")
          .option("checkpointLocation", f"{out_dir}/_ckpt_rejected").trigger(availableNow=True).start())
    q1.awaitTermination()
    q2.awaitTermination()
    return f"{out_dir}/scored", f"{out_dir}/rejected"


def stream_rule_counts(spark: SparkSession, source_dir: str, schema: T.StructType, meta: InputMetadata, out_dir: str) -> str:
    """Running rejected-row counts per (rule, field) over the stream."""
    stream = read_stream(spark, source_dir, schema)
    errs = stream.select(F.explode(rule_errors(stream, meta)).alias("e"))
    parts = F.split("e", ":", 2)
    counts = errs.groupBy(parts.getItem(0).alias("rule"), parts.getItem(1).alias("field")).agg(F.count(F.lit(1)).alias("rejected_rows"))
    target = f"{out_dir}/rule_counts"

    def sink(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    q = (counts.writeStream.outputMode("complete").foreachBatch(sink)
         .option("checkpointLocation", f"{out_dir}/_ckpt_counts").trigger(availableNow=True).start())
    q.awaitTermination()
    return target
