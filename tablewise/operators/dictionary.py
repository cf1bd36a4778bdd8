"""Dictionary features: one-hot encoding by a (field, value, index) table.

The categories of a table are rows, not literals: they are counted, numbered and joined by Spark, never
collected, so a column may have any number of them and the plan does not grow.  Features are
Spark ML vectors, sparse where that is smaller: ``numeric`` columns first, then one place a category.

The dictionary is kept as a written table; numbering sorts it by ranges and adds each
range's offset to the place in the range, so no field, however many values it has, meets in one task.
A join with it is a broadcast only where its measured size allows; adaptive execution
splits the rows of a frequent value otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import broadcast_if_small
from ..session import checkpoint

SCHEMA = "field string, value string, index long, count long"


@dataclass
class Dictionary:
    """Table of (field, value, index, count); indexes of a field run from 0 in the order of its values."""

    table: DataFrame
    fields: list[str]
    sizes: dict[str, int]

    def entries(self, field: str) -> DataFrame:
        return self.table.where(F.col("field") == field)

    def indexed(self, df: DataFrame, suffix: str = "_index") -> DataFrame:
        """``df`` with each field's index as a column; null where train has not seen the value."""
        for f in self.fields:
            own = self.entries(f).select(F.col("value").alias(f"_{f}_value"), F.col("index").alias(f + suffix))
            own = broadcast_if_small(own, self.sizes[f])
            df = df.join(own, F.col(f).cast("string") == F.col(f"_{f}_value"), "left").drop(f"_{f}_value")
        return df

    def transform(self, df: DataFrame, numeric: list[str] | None = None, features: str = "features") -> DataFrame:
        """``df`` with ``features``: the numeric columns, then the categories of every field; unseen and null values have no place set."""
        numeric = list(numeric or [])
        rows = self.indexed(df, "_at")
        at, hot = [f"{f}_at" for f in self.fields], [f"{f}_hot" for f in self.fields]
        # a last index stands for what is unseen; the encoder drops it
        rows = rows.withColumns({a: F.coalesce(F.col(a), F.lit(self.sizes[f])).cast("double") for a, f in zip(at, self.fields)})
        # the encoder learns its sizes from one row with the largest indexes
        largest = df.sparkSession.createDataFrame([tuple(float(self.sizes[f]) for f in self.fields)], ", ".join(f"`{a}` double" for a in at))
        encoder = OneHotEncoder(inputCols=at, outputCols=hot, dropLast=True).fit(largest)
        rows = VectorAssembler(inputCols=[*numeric, *hot], outputCol=features).transform(encoder.transform(rows))
        return rows.drop(*at, *hot)

    def feature_names(self, numeric: list[str] | None = None) -> DataFrame:
        """place, feature: the name of every place of the vectors, as rows."""
        spark, numeric = self.table.sparkSession, list(numeric or [])
        base, at = [], len(numeric)
        for f in self.fields:
            base.append((f, at))
            at += self.sizes[f]
        starts = spark.createDataFrame(base, "field string, start long")
        names = self.table.join(F.broadcast(starts), "field").select((F.col("start") + F.col("index")).alias("place"), F.concat_ws("_", "field", "value").alias("feature"))
        return spark.createDataFrame(list(enumerate(numeric)), "place long, feature string").unionByName(names)

    def save(self, path: str) -> None:
        self.table.write.mode("error").parquet(path)


def fit_dictionary(train: DataFrame, fields: list[str], min_count: int = 1, max_partitions: int | None = None) -> Dictionary:
    """T4: the values of ``fields`` in the train rows that occur at least ``min_count`` times, numbered in their order; nulls are no values."""
    spark = train.sparkSession
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    counts = train.select(pairs.alias("_p")).select("_p.*").where("value IS NOT NULL").groupBy("field", "value").agg(F.count(F.lit(1)).alias("count"))
    counts = counts.where(F.col("count") >= min_count)
    ranges = counts.repartitionByRange(max_partitions, "field", "value") if max_partitions else counts.repartitionByRange("field", "value")
    # written, so that ranges and places are those of one evaluation
    placed = checkpoint(
        ranges.sortWithinPartitions("field", "value").select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_id"))
    )
    parts = placed.groupBy("field", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("field").orderBy("_range")) - F.col("_n")
    offsets = parts.select("field", "_range", "_first", before.alias("_before"))  # a row a range and field
    table = placed.join(broadcast_if_small(offsets, offsets.count()), ["field", "_range"]).select(
        "field", "value", (F.col("_id") - F.col("_first") + F.col("_before")).alias("index"), "count"
    )
    return _sized(checkpoint(table), list(fields), spark)


def _sized(table: DataFrame, fields: list[str], spark: SparkSession) -> Dictionary:
    sizes = {r["field"]: r["n"] for r in table.groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a field
    return Dictionary(table, fields, {f: sizes.get(f, 0) for f in fields})


def load_dictionary(spark: SparkSession, path: str, fields: list[str]) -> Dictionary:
    return _sized(spark.read.schema(SCHEMA).parquet(path), fields, spark)
