"""Spark session helpers.

The library never creates its own cluster settings behind the caller's back:
``get_session`` is a convenience for tests, the bench and local runs.  On a
cluster the caller passes its own session and only ``ensure_checkpoint_dir``
is consulted, which reads ``spark.checkpoint.dir`` and sets a local folder
only when the setting is absent (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_CKPT: str | None = None


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tablewise",
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    cpus = os.environ.get("BENCH_CPUS", "8")
    parts = shuffle_partitions or int(cpus)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as is.  A machine-local temporary folder is only made
    when nothing is configured, i.e. in tests and local runs.
    """
    global _LOCAL_CKPT
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all executors share")
    if _LOCAL_CKPT is None:
        _LOCAL_CKPT = tempfile.mkdtemp(prefix="tablewise-ckpt-", dir="/tmp")
    sc.setCheckpointDir(_LOCAL_CKPT)
    return _LOCAL_CKPT


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint root for written intermediate tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}"


def checkpoint(df):
    """Reliable checkpoint into the session's checkpoint folder (never localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
