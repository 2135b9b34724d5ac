"""Batching, content-hash caching and staged retry of an external enrichment step."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.functions import text as tx
from quirework.plans.anchored import anchored_runs
from quirework.plans.ordered import RowNumber, RunningSum, ordered_scan, same_keys
from quirework.session import materialize

# --- fixed values -----------------------------------------------------------------
PACK_CHARS = 14_000
UNIT_OVERHEAD = 80
FRAGMENTS_PER_CALL = 8
CODE_BLOCKS_PER_CALL = 4
# ----------------------------------------------------------------------------------


def pack(
    units: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    size: Column,
    capacity: int = PACK_CHARS,
    overhead: int = UNIT_OVERHEAD,
    name: str = "chunk",
) -> DataFrame:
    """Greedy packing in order: a unit opens a new chunk if it would overflow the open one.

    With characters counted from the start of the key, a chunk is a run bounded from its
    first unit, so the packing is exact and still done bucket by bucket.
    """
    sized = units.withColumn("__w", (size + overhead).cast("long"))
    placed = ordered_scan(sized, keys, bucket, order, RunningSum("__end", F.col("__w")))
    packed = anchored_runs(placed, keys, bucket, order, F.col("__end") - F.col("__w"), F.col("__end"), capacity, name)
    return packed.select(*units.columns, name)


def fixed_batches(rows: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str], size: int, name: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` rows, counted from 0."""
    numbered = ordered_scan(rows, keys, bucket, order, RowNumber("__n"))
    return numbered.withColumn(name, F.floor((F.col("__n") - 1) / size).cast("long")).drop("__n")


def code_batch_size(requested: int) -> int:
    return max(1, min(CODE_BLOCKS_PER_CALL, requested))


def cache_key(*parts: Column) -> Column:
    """Digest of everything the answer depends on, separated unambiguously."""
    return tx.sha1_text(F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts]))


def split_cached(requests: DataFrame, cache: DataFrame, keys: Sequence[str], answer: str) -> tuple[DataFrame, DataFrame]:
    """(answered, missing): a cached answer counts only if its key, which covers the input
    hash, is equal and it is not empty.  A null key is one more key.  Of several stored answers to one key one counts: the latest by
    the column ``latest`` if the cache has it, else the greatest."""
    order = F.col("latest") if "latest" in cache.columns else F.col(answer)
    filled = cache.filter(F.coalesce(F.trim(F.col(answer)), F.lit("")) != "")
    usable = filled.groupBy(*keys).agg(F.max_by(answer, order).alias(answer))
    return same_keys(requests, usable, keys), same_keys(requests, usable, keys, "left_anti")


class Client(Protocol):
    """The external service.  ``answer`` gets the texts of one call and returns what came
    back by id; ids may be absent.  Credentials are the client's own business."""

    def answer(self, ids: Sequence[str], texts: Sequence[str]) -> dict[str, str]: ...


def call_batches(units: DataFrame, unit_id: str, text: str, batch: Sequence[str], make_client: Callable[[], Client], tries: int = 3) -> DataFrame:
    """One call per batch.  Answers and failures come back as rows, never as exceptions, so
    one bad call does not lose the partition.  Batches are small by construction."""
    schema = T.StructType(
        [units.schema[unit_id], T.StructField("answer", T.StringType()), T.StructField("error", T.StringType())]
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        client = make_client()
        ids = group[unit_id].tolist()
        error = None
        got: dict = {}
        for _ in range(tries):
            try:
                got = client.answer(ids, group[text].tolist())
                error = None
                break
            except Exception as problem:  # the service may fail in any way
                error = f"{type(problem).__name__}: {problem}"
        answers = [got.get(i) for i in ids]
        missing = [error or (None if a else "missing answer") for a in answers]
        return pd.DataFrame({unit_id: ids, "answer": answers, "error": missing})

    return units.groupBy(*batch).applyInPandas(run, schema)


def call_singles(units: DataFrame, unit_id: str, text: str, make_client: Callable[[], Client], tries: int = 4) -> DataFrame:
    """One call per unit, streaming through the partition."""
    schema = T.StructType(
        [units.schema[unit_id], T.StructField("answer", T.StringType()), T.StructField("error", T.StringType())]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for frame in frames:
            answers, errors = [], []
            for one, body in zip(frame[unit_id], frame[text]):
                answer = error = None
                for _ in range(tries):
                    try:
                        answer = client.answer([one], [body]).get(one)
                        error = None if answer else "missing answer"
                        break
                    except Exception as problem:
                        error = f"{type(problem).__name__}: {problem}"
                answers.append(answer)
                errors.append(error)
            yield pd.DataFrame({unit_id: frame[unit_id], "answer": answers, "error": errors})

    return units.select(unit_id, text).mapInPandas(run, schema)


def cascade(units: DataFrame, unit_id: str, stages: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Run stages in turn, each on what the earlier ones left unanswered.

    A stage maps units to (unit_id, answer, error).  The result has one row per unit with
    the stage that answered it, or the last error.  Each stage's answers are written once:
    both the result and the next stage read them, and neither they nor a lost executor may
    ask the service again.
    """
    pending, done = units, None
    for number, (label, stage) in enumerate(stages, 1):
        result = materialize(stage(pending).select(unit_id, "answer", "error")).withColumn("stage", F.lit(label))
        answered = F.coalesce(F.col("answer"), F.lit("")) != ""
        kept = result if number == len(stages) else result.filter(answered)
        done = kept if done is None else done.unionByName(kept)
        pending = pending.join(result.filter(answered).select(unit_id), unit_id, "left_anti")
    return done


def merge_results(results: Sequence[DataFrame], unit_id: str, answer: str, seq: str) -> DataFrame:
    """Union of partial results; the highest ``seq`` wins where ids repeat."""
    merged = results[0]
    for more in results[1:]:
        merged = merged.unionByName(more)
    return merged.groupBy(unit_id).agg(F.max_by(answer, seq).alias(answer))


def missing_ids(expected: DataFrame, got: DataFrame, key: str) -> DataFrame:
    return expected.select(key).distinct().join(got.select(key), key, "left_anti")


def with_fallback(remote: Column, local: Column) -> Column:
    """The remote answer, or the local rule where there is none."""
    return F.coalesce(F.nullif(remote, F.lit("")), local)


def progress(tasks: DataFrame, status: str, states: Sequence[str]) -> DataFrame:
    """One row of task counts per state."""
    return tasks.agg(
        F.count(F.lit(1)).alias("tasks_total"),
        *[F.count_if(F.col(status) == s).alias(f"tasks_{s.lower()}") for s in states],
    )
