"""Session settings the operators rely on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "quirework", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names.

    Where none is set, a local session (one machine, as in tests) gets a folder of its own; on a
    cluster that is an error, as each executor would write to its own disk.
    """
    context = spark.sparkContext
    configured = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if configured:
        return configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(tempfile.gettempdir(), f"quirework-{context.applicationId}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike cached or local blocks."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint()


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate table once, in the shared folder, and read it back.

    For results that several branches need and that are dear to recompute: narrow values
    derived from wide text, chains of ordered scans, answers of a paid service.  Unlike a
    cache it survives lost executors, and unlike a checkpoint it keeps column pruning.
    The table goes when the session's JVM ends.  Writing runs a job, so a query that uses this
    starts work while it is built.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(folder)
