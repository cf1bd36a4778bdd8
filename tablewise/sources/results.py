"""Result sinks and scans.

Results are tidy DataFrames; sinks write them with Spark's commit protocol
(atomic per job) into a folder the caller names -- on a cluster a shared
filesystem or object store.  Non-finite doubles become NULL before JSON, as
the reference forbids NaN in its JSON artefacts.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import finite_or_null


class ResultReadError(ValueError):
    pass


def json_safe(df: DataFrame) -> DataFrame:
    """Non-finite floating values -> NULL (JSON has no NaN/Infinity)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(finite_or_null(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_json(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A5: JSON-lines sink of a result table."""
    w = json_safe(df).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def read_results(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """Scan a folder of result files with an explicit schema; files that do not
    match it raise (FAILFAST), as a missing or corrupt result file does."""
    try:
        df = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multiline).json(path)
        df.limit(1).count()
    except Exception as e:  # noqa: BLE001
        raise ResultReadError(f"result files at {path} are missing or corrupt") from e
    return df


def write_prepared(prepared: DataFrame, path: str, metadata: dict) -> None:
    """Prepared rows partitioned by split (parquet) plus metadata JSON."""
    prepared.write.mode("overwrite").partitionBy("split").parquet(f"{path}/rows")
    spark = prepared.sparkSession
    meta = spark.createDataFrame([(json.dumps(metadata, sort_keys=True),)], "metadata string")
    meta.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def read_prepared(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    rows = spark.read.parquet(f"{path}/rows")
    text = spark.read.text(f"{path}/metadata").first()["value"]
    return rows, json.loads(text)


# The keys that a model bundle must have.
BUNDLE_KEYS = (
    "model_name", "mode", "model", "label_encoder", "input_columns", "required_columns", "numeric_columns",
    "categorical_columns", "numeric_ranges", "categorical_options",
)
MODES = ("mllib", "parameters")


def check_bundle(bundle: dict) -> None:
    """All keys are there, and the column lists agree with one another."""
    missing = sorted(set(BUNDLE_KEYS) - set(bundle))
    if missing:
        raise ResultReadError(f"model bundle misses {missing}")
    inputs = set(bundle["input_columns"])
    if set(bundle["required_columns"]) != inputs:
        raise ResultReadError("model bundle: required columns differ from the input columns")
    if {*bundle["numeric_columns"], *bundle["categorical_columns"]} != inputs:
        raise ResultReadError("model bundle: typed columns differ from the input columns")
    if bundle["mode"] not in MODES:
        raise ResultReadError(f"model bundle: unknown mode {bundle['mode']}")


def save_bundle(spark: SparkSession, path: str, bundle: dict, model=None) -> None:
    """bundle = one JSON text with all keys, and for mode ``mllib`` the model's own folder.

    In mode ``parameters`` the key ``model`` holds the fitted arrays as lists."""
    check_bundle(bundle)
    if bundle["mode"] == "mllib":
        model.write().overwrite().save(f"{path}/model")
    text = json.dumps(bundle, sort_keys=True)
    spark.createDataFrame([(text,)], "bundle string").coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(f"{path}/bundle")


def load_bundle(spark: SparkSession, path: str) -> dict:
    """Read and check a bundle; a missing or unreadable one raises."""
    try:
        bundle = json.loads(spark.read.text(f"{path}/bundle").first()["value"])
    except Exception as e:  # noqa: BLE001
        raise ResultReadError(f"model bundle at {path} is missing or corrupt") from e
    if not isinstance(bundle, dict):
        raise ResultReadError("model bundle is not an object")
    check_bundle(bundle)
    return bundle
