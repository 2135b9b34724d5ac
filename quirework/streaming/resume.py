"""Resumable enrichment: new page files are processed once, finished pages are skipped.

A file stream with an available-now trigger picks up what arrived since the last run; each
micro-batch drops the pages whose (key, input hash) is already answered and appends the new
answers to a keyed Parquet store.  A batch that runs again after a failure finds its own
answers in the store, so nothing is asked twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.operators.batches import cache_key, split_cached
from quirework.session import checkpoint_dir

STORE_SCHEMA = "page string, input_hash string, answer string, error string"


def read_store(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(STORE_SCHEMA).option("ignoreMissingFiles", True).parquet(store)


def run_available(
    spark: SparkSession,
    source: str,
    store: str,
    enrich: Callable[[DataFrame], DataFrame],
    version: str,
    checkpoint: str | None = None,
) -> None:
    """Process what is available in ``source`` (JSON rows of page, text) and stop.

    ``enrich`` maps (page, input_hash, text) to (page, input_hash, answer, error)."""
    spark.createDataFrame([], STORE_SCHEMA).write.mode("append").parquet(store)

    def batch(rows: DataFrame, _: int) -> None:
        hashed = rows.withColumn("input_hash", cache_key(F.lit(version), F.col("page"), F.col("text")))
        _, missing = split_cached(hashed.dropDuplicates(["page", "input_hash"]), read_store(spark, store), ["page", "input_hash"], "answer")
        enrich(missing).select("page", "input_hash", "answer", "error").write.mode("append").parquet(store)

    query = (
        spark.readStream.schema("page string, text string")
        .json(source)
        .writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint or f"{checkpoint_dir(spark)}/resume")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def progress(store: DataFrame, expected: DataFrame) -> DataFrame:
    """Counts of expected, answered, failed and pending pages from the store."""
    latest = store.groupBy("page").agg(
        F.bool_or(F.coalesce(F.col("answer"), F.lit("")) != "").alias("answered"), F.bool_or(F.col("error").isNotNull()).alias("failed")
    )
    joined = expected.select("page").distinct().join(latest, "page", "left")
    answered, failed = F.coalesce("answered", F.lit(False)), F.coalesce("failed", F.lit(False))
    return joined.agg(
        F.count(F.lit(1)).alias("tasks_total"),
        F.count_if(answered).alias("tasks_translated"),
        F.count_if(~answered & failed).alias("tasks_failed"),
        F.count_if(~answered & ~failed).alias("tasks_pending"),
    )
