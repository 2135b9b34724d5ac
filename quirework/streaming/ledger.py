"""Asks of an external service as an append-only ledger, so that none is repeated without need.

Before a call the ledger gets an ``asked`` row for each key, after it an ``answered`` or a ``failed`` one.  An ask whose
outcome was lost with a crash still counts, so no key is asked more than ``most`` times, whatever breaks.  A
failed key waits 1, 2, 4, … runs.  The state of a key is an aggregate over the ledger; nothing is updated.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.operators.batches import cache_key
from quirework.plans.ordered import same_keys
from quirework.session import checkpoint_dir, materialize

ASKED, ANSWERED, FAILED = "asked", "answered", "failed"
NEW, DUE, WAITING, GIVEN_UP = "new", "due", "waiting", "given up"
KEYS = ("page", "input_hash")
LEDGER = "page string, input_hash string, run long, outcome string, answer string, error string"
REQUESTS = "page string, input_hash string, text string"


def request_states(requests: DataFrame, ledger: DataFrame, keys: Sequence[str], run: Column, most: int) -> DataFrame:
    """``requests`` with ``asks`` and ``state`` before run number ``run``.

    ``ledger(*keys, run, outcome)``: one answered row settles a key for good.  A null key is one more key.
    """
    asked = F.col("outcome") == ASKED
    told = ledger.groupBy(*keys).agg(
        F.count_if(asked).alias("asks"), F.max(F.when(asked, F.col("run"))).alias("__last"),
        F.bool_or(F.coalesce(F.col("outcome") == ANSWERED, F.lit(False))).alias("__answered"),
    )
    asks = F.coalesce("asks", F.lit(0)).cast("long")
    rested = run - F.col("__last") >= F.pow(F.lit(2.0), asks - 1)
    state = (
        F.when(F.col("__answered"), ANSWERED).when(asks == 0, NEW).when(asks >= most, GIVEN_UP)
        .when(rested, DUE).otherwise(WAITING)
    )
    return same_keys(requests, told, keys, "left").select(*requests.columns, asks.alias("asks"), state.alias("state"))


def run_available(
    spark: SparkSession, source: str, store: str, enrich: Callable[[DataFrame], DataFrame], version: str, most: int = 2, checkpoint: str | None = None
) -> int:
    """One run: take in what is new in ``source`` (JSON rows of page, text), ask what is new or due; returns the run's number.

    ``enrich`` maps (page, input_hash, text) to (page, input_hash, answer, error); a row without an answer, or
    none at all, is a failure.  ``store`` holds the requests and the ledger.
    """
    requests, ledger = f"{store}/requests", f"{store}/ledger"
    spark.createDataFrame([], REQUESTS).write.mode("append").parquet(requests)
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)

    def take(rows: DataFrame, _: int) -> None:
        hashed = rows.withColumn("input_hash", cache_key(F.lit(version), F.col("page"), F.col("text"))).dropDuplicates(KEYS)
        known = spark.read.schema(REQUESTS).parquet(requests).select(*KEYS)
        same_keys(hashed, known, KEYS, "left_anti").select("page", "input_hash", "text").write.mode("append").parquet(requests)

    stream = spark.readStream.schema("page string, text string").json(source).writeStream.foreachBatch(take)
    place = checkpoint or f"{checkpoint_dir(spark)}/ledger"
    stream.option("checkpointLocation", place).trigger(availableNow=True).start().awaitTermination()

    held = spark.read.schema(LEDGER).parquet(ledger)
    run = held.agg(F.coalesce(F.max("run"), F.lit(0)) + 1).first()[0]
    states = request_states(spark.read.schema(REQUESTS).parquet(requests), held, KEYS, F.lit(run), most)
    todo = materialize(states.filter(F.col("state").isin(NEW, DUE)).select("page", "input_hash", "text"))

    def note(rows: DataFrame, outcome: Column, answer: Column, error: Column) -> None:
        columns = ["page", "input_hash", F.lit(run).cast("long").alias("run"), outcome.alias("outcome"), answer.alias("answer"), error.alias("error")]
        rows.select(*columns).write.mode("append").parquet(ledger)

    nothing = F.lit(None).cast("string")
    note(todo, F.lit(ASKED), nothing, nothing)
    # The outcome is written by the job that asks, and read back by no second one.
    got = enrich(todo).select("page", "input_hash", "answer", "error")
    filled = F.coalesce(F.trim("answer"), F.lit("")) != ""
    note(got, F.when(filled, ANSWERED).otherwise(FAILED), F.when(filled, F.col("answer")), F.coalesce("error", F.when(~filled, F.lit("missing answer"))))
    return run
