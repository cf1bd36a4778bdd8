"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.session import ensure_checkpoint_dir

def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow, giving free memory back to the system when its task ends.

    Workers outlive tasks, and several stay idle beside the ones that work."""

    def inner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # only glibc has it
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return inner


ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: what one batch between the JVM and Python may hold; long texts make few rows large
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1024


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches in bytes and rows.

    Plans read the setting when they run, which for a returned DataFrame is
    after the operator has ended, so it stays set."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; every other code point stays."""
    return F.translate(col, ASCII_UPPER, ASCII_UPPER.lower())


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint root that every executor can reach."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = shared_path(spark, name)
    with shuffles_cleaned(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_key(col: str | Column) -> Column:
    """A string key under which equal ids, null included, compare equal."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))


CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_cleaned(spark: SparkSession):
    """Within, Spark deletes an execution's shuffle files when that execution ends."""
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)
