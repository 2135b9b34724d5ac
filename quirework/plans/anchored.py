"""Runs that restart at a bound measured from their first row.

A row joins the open run while ``end <= anchor + limit``, where ``anchor`` is the ``start``
of the run's first row; otherwise it opens the next run.  Line grouping (start = end =
top of a word) and size-bounded packing (start / end = characters packed before / after
the record) are both this shape.

The walk is sequential, but a bucket is a function of the one number that enters it.
Each bucket is summarised, in its own task, as that function: from which incoming bound
on which row is the first to break, and the anchor and number of breaks that follow from
there.  The per-key walk then reads one summary per bucket, and the rows are numbered
in a second pass over the buckets.

Spark partitions and sorts the rows; the Python side streams a sorted partition and handles
one bucket at a time with array operations.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _values(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy()


def _offsets(table: pa.Table, place: Sequence[str]) -> np.ndarray:
    changed = np.ones(table.num_rows, dtype=bool)
    columns = [_values(table, c) for c in place]
    changed[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.append(np.flatnonzero(changed), table.num_rows)


def _groups(batches: Iterator[pa.RecordBatch], place: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole groups of a sorted partition, with the offsets of the groups.
    Only the group that a batch leaves open is held over."""
    held: list[pa.Table] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        cuts = _offsets(table, place)[:-1]
        if held and all(table.column(c)[0] == held[0].column(c)[0] for c in place):
            cuts = cuts[1:]
        if len(cuts) == 0:
            held.append(table)
            continue
        ready = pa.concat_tables([*held, table.slice(0, int(cuts[-1]))])
        held = [table.slice(int(cuts[-1]))]
        if ready.num_rows:
            yield ready, _offsets(ready, place)
    if held:
        ready = pa.concat_tables(held)
        yield ready, _offsets(ready, place)


def _jump(start: np.ndarray, end: np.ndarray, limit: int) -> np.ndarray:
    """For each row taken as an anchor: index of the row that breaks its run."""
    size = len(start)
    nxt = np.searchsorted(end, start + limit, side="right")
    return np.maximum(nxt, np.arange(1, size + 1))


def bucket_function(start: np.ndarray, end: np.ndarray, limit: int):
    """Arrays (bound, anchor, breaks): the first entry whose bound exceeds the incoming
    ``anchor + limit`` tells the anchor and the breaks at the end of the bucket."""
    size = len(start)
    nxt = np.append(_jump(start, end, limit), size)
    breaks = np.append(np.ones(size, dtype=np.int64), 0)
    last = np.append(np.arange(size), size)
    while (nxt[:size] < size).any():
        breaks = breaks + np.where(nxt < size, breaks[nxt], 0)
        last = np.where(nxt < size, last[nxt], last)
        nxt = nxt[nxt]
    # Only rows within one limit of the bucket's first row can be the first to break.
    reach = min(size, int(np.searchsorted(end, start[0] + limit, side="right")) + 1)
    anchor, breaks, bound = start[last[:reach]], breaks[:reach], end[:reach]
    keep = np.append((np.diff(anchor) != 0) | (np.diff(breaks) != 0), True)
    return bound[keep], anchor[keep], breaks[keep]


def enter(bound, anchor, breaks, carried: int | None, limit: int) -> tuple[int, int]:
    """Apply one bucket's function to the anchor that enters it."""
    if carried is None:
        return int(anchor[0]), int(breaks[0])
    at = int(np.searchsorted(bound, carried + limit, side="right"))
    if at == len(bound):
        return carried, 0
    return int(anchor[at]), int(breaks[at])


def _sorted(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    placed = df.repartition(*by) if by else df.coalesce(1)
    return placed.sortWithinPartitions(*by, *order)


def anchored_runs(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    start: Column,
    end: Column,
    limit: int,
    name: str = "run",
) -> DataFrame:
    """Add the 1-based run number per key; ``start`` and ``end`` are whole numbers that do
    not decrease along the order.  Columns pass through the tasks, so select narrow ones."""
    keys, order = list(keys), list(order)
    place = [*keys, "__bucket"]
    base = df.withColumns(
        {"__bucket": bucket.cast("long"), "__start": start.cast("long"), "__end": end.cast("long")}
    )
    types = {f.name: f for f in base.schema.fields}
    longs = T.ArrayType(T.LongType())

    summary_schema = T.StructType([types[c] for c in place] + [T.StructField(n, longs) for n in ("bound", "anchor", "breaks")])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, cuts in _groups(batches, place):
            begin, stop = _values(whole, "__start"), _values(whole, "__end")
            found = [bucket_function(begin[a:b], stop[a:b], limit) for a, b in zip(cuts[:-1], cuts[1:])]
            out = whole.select(place).take(pa.array(cuts[:-1]))
            for i, column in enumerate(("bound", "anchor", "breaks")):
                out = out.append_column(column, pa.array([f[i] for f in found], pa.list_(pa.int64())))
            yield from out.to_batches()

    narrow = base.select(*place, *[c for c in order if c not in place], "__start", "__end")
    summaries = _sorted(narrow, place, order).mapInArrow(summarise, summary_schema)

    entry_schema = T.StructType([types[c] for c in place] + [T.StructField("__anchor", T.LongType()), T.StructField("__run", T.LongType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple | None = None
        carried: int | None = None
        run = 0
        for batch in batches:
            anchors: list[int | None] = []
            runs: list[int] = []
            names = list(zip(*[batch.column(c).to_pylist() for c in keys])) if keys else [()] * batch.num_rows
            parts = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("bound", "anchor", "breaks")]
            for key, bound, anchor, breaks in zip(names, *parts):
                if key != known:
                    known, carried, run = key, None, 0
                anchors.append(carried)
                runs.append(run)
                carried, made = enter(bound, anchor, breaks, carried, limit)
                run += made
            columns = [batch.column(c) for c in place] + [pa.array(anchors, pa.int64()), pa.array(runs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*place, "__anchor", "__run"])

    entries = _sorted(summaries, keys, ["__bucket"]).mapInArrow(walk, entry_schema)

    # A bucket's entry state sorts in front of its rows, which saves a join.
    marked = base.withColumn("__row", F.lit(1)).unionByName(entries.withColumn("__row", F.lit(0)), allowMissingColumns=True)
    kept = df.columns
    result_schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields] + [T.StructField(name, T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, cuts in _groups(batches, place):
            begin, stop, before = (
                whole.column(c).combine_chunks().fill_null(0).to_numpy() for c in ("__start", "__end", "__run")
            )
            entered = whole.column("__anchor").take(pa.array(cuts[:-1])).to_pylist()
            run = np.zeros(whole.num_rows, dtype=np.int64)
            for carried, a, b in zip(entered, cuts[:-1], cuts[1:]):
                first, size = a + 1, b - a - 1
                nxt = _jump(begin[first:b], stop[first:b], limit)
                at = 0 if carried is None else int(np.searchsorted(stop[first:b], carried + limit, side="right"))
                opens = np.zeros(size, dtype=np.int64)
                while at < size:
                    opens[at] = 1
                    at = int(nxt[at])
                run[first:b] = np.cumsum(opens) + int(before[a])
            rows = np.delete(np.arange(whole.num_rows), cuts[:-1])
            yield from whole.select(kept).append_column(name, pa.array(run)).take(pa.array(rows)).to_batches()

    return _sorted(marked, place, ["__row", *order]).mapInArrow(number, result_schema)
