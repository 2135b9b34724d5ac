"""Ordered computations that never put a whole key into one task.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task, which fails
once one key holds a third of the data.  ``OrderedScan`` splits each key into buckets of
its ordering column (a day, a range of ids), runs the window inside ``(key, bucket)``,
and carries the state across buckets on one summary row per bucket:

* rows shuffle once, on ``(key, bucket)``; the local window and the join back to the
  summaries share that partitioning;
* the summary is built by a partial aggregate, so only one row per bucket and task moves;
* only the per-key sequence of summaries is walked in order.

The bucket column must not decrease along the scan order, and the order columns must
identify a row within a key.  Null keys, and null order values and with them buckets, are ordinary
values: a null key is one more key, a null bucket comes first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.session import materialize

#: Rows a bucket is meant to hold where ``even_buckets`` cuts, and sampled rows a cut is taken from.
BUCKET_ROWS, SAMPLED = 200_000, 4


def _stretch(value: Column, width: int) -> Column:
    """Start of the stretch of ``width`` a whole number falls in; exact for any 64-bit value."""
    return value - F.pmod(value, F.lit(width).cast("long"))


def id_bucket(column: str | Column, width: int = 100_000) -> Column:
    """Bucket of a whole-number ordering column; ``width`` bounds the rows per unique-id bucket."""
    return _stretch((F.col(column) if isinstance(column, str) else column).cast("long"), width)


def micros(column: str | Column) -> Column:
    """Microseconds since the epoch (session time zone UTC)."""
    base = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(base.cast("timestamp"))


def time_bucket(column: str | Column, seconds: int = 86_400) -> Column:
    return _stretch(micros(column), seconds * 1_000_000)


def even_buckets(
    df: DataFrame, keys: Sequence[str], cell: Column, order: Sequence[str], name: str = "__even", rows: int | None = None
) -> DataFrame:
    """Add a bucket of about ``rows`` rows at most, however many rows of a key share a ``cell``.

    A cell is a stretch of the first order column and may hold any number of rows: a page with all its boxes at
    one height is one cell.  A sample chosen by the hash of the order columns, the same in every run, is
    sorted per cell, and every ``SAMPLED``-th sampled row is a cut, so cells below the size have none and ties in the
    first column are cut by the next ones.  The bucket of a row is its cell and the number of cuts not above it,
    found by bisection.  Cells beyond 31 bits share the outermost bucket numbers, which keeps the order; the null cell comes first.

    The cuts, one per ``rows`` rows, are written first, by one pass over the order columns: the join with them
    then has a known size, and there is none where no cell is that large.
    """
    rows = BUCKET_ROWS if rows is None else rows
    far = F.lit(2**31)
    whole = cell.cast("long")
    placed = df.withColumn("__cell", F.when(whole.isNull(), -far - 1).otherwise(F.greatest(-far, F.least(far, whole))))
    mark = F.struct(*order)
    chosen = F.pmod(F.xxhash64(*order), F.lit(max(rows // SAMPLED, 1))) == 0
    cuts = (
        placed.filter(chosen).groupBy(*keys, "__cell").agg(F.sort_array(F.collect_list(mark)).alias("__all"))
        .select(*keys, "__cell", F.filter("__all", lambda _, i: (i + 1) % SAMPLED == 0).alias("__cuts")).filter(F.size("__cuts") > 0)
    )
    cuts = materialize(cuts)
    if cuts.isEmpty():
        return placed.withColumn(name, F.col("__cell") * far).drop("__cell")

    def passed(found: Column, step: Column) -> Column:
        ahead = found + step
        return F.when((ahead <= F.size("__cuts")) & (F.get("__cuts", ahead - 1) <= mark), ahead).otherwise(found)

    piece = F.reduce(F.array(*[F.lit(2**b) for b in range(24, -1, -1)]), F.lit(0), passed)
    joined = same_keys(placed, cuts, [*keys, "__cell"], "left")
    bucket = F.col("__cell") * far + F.when(F.col("__cuts").isNotNull(), piece).otherwise(F.lit(0))
    return joined.select(*df.columns, bucket.alias(name))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equality join on ``keys`` in which a null key equals itself; the keys come out once, from the left.

    A struct of nulls equals itself, so the join stays an equality join that hashes and sorts on one column.
    """
    right = right.withColumn("__same", F.struct(*keys)).drop(*keys)
    return left.withColumn("__same", F.struct(*keys)).join(right, "__same", how).drop("__same")


@dataclass(frozen=True)
class Step:
    """One derived column of a scan."""

    name: str
    expr: Column | None = None


class RowNumber(Step):
    """1-based position within the key."""


class RunningSum(Step):
    """Sum of ``expr`` up to and including the row."""


class MaxBefore(Step):
    """Maximum of ``expr`` over the rows strictly before this one."""


class LastKnown(Step):
    """Latest non-null ``expr`` up to and including the row."""


class Previous(Step):
    """``expr`` of the row just before."""


class Following(Step):
    """``expr`` of the row just after."""


class GroupSum(Step):
    """Sum of ``expr`` over the whole key."""


class GroupLast(Step):
    """Latest non-null ``expr`` of the whole key."""


class GroupMax(Step):
    """Maximum of ``expr`` over the whole key."""


class Opener(Step):
    """Order columns, as a struct, of the row that opened the island a row is in.  A row opens an island unless
    its ``expr`` is at most ``gap`` past the greatest ``end`` before it.  ``expr`` does not decrease along the scan,
    and rows without it have a bucket of their own; each opens an island."""

    def __init__(self, name: str, expr: Column, end: Column, gap):
        super().__init__(name, expr)
        object.__setattr__(self, "end", end)
        object.__setattr__(self, "gap", gap)


@dataclass(frozen=True)
class OrderedScan:
    keys: Sequence[str]
    bucket: str
    order: Sequence[str]

    def extend(self, df: DataFrame, *steps: Step) -> DataFrame:
        # A struct of nulls equals itself, so the join back to the summaries loses no null key, and
        # windows, aggregate and join still share one partitioning.
        kept = df.columns
        df = df.withColumn("__place", F.struct(*self.keys, self.bucket))
        place = ["__place"]
        inside = Window.partitionBy(*place).orderBy(*self.order)
        so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = inside.rowsBetween(Window.unboundedPreceding, -1)
        across = Window.partitionBy(*[F.col(f"__place.{k}") for k in self.keys]).orderBy(F.col(f"__place.{self.bucket}"))
        earlier = across.rowsBetween(Window.unboundedPreceding, -1)
        whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # A single ordering column keeps the summary in a hash aggregate.
        rank = F.col(self.order[0]) if len(self.order) == 1 else F.struct(*self.order)

        def at_edge(edge, value: Column, order: Column, ignore: bool = False) -> Column:
            """Value of the first or last row of a bucket; the bucket of null order values has one row."""
            only = F.first(value, ignorenulls=ignore)
            return F.coalesce(edge(value, order), F.when(F.count(rank) == 0, only))

        # Openers depend on the running end, so they take a second column in the same window, and the summary and
        # the carry of one are built in two steps as well.
        local, summary, carry, final, second = {}, {}, {}, {}, {}
        for step in steps:
            kind, name = type(step), step.name
            here, total, moved = f"__l_{name}", f"__s_{name}", f"__c_{name}"
            if kind is RowNumber:
                local[here] = F.row_number().over(inside).cast("long")
                summary[total] = F.count(F.lit(1))
                carry[moved] = F.sum(total).over(earlier)
                final[name] = F.col(here) + F.coalesce(F.col(moved), F.lit(0))
            elif kind is RunningSum:
                local[here] = F.sum(step.expr).over(so_far)
                summary[total] = F.sum(step.expr)
                carry[moved] = F.sum(total).over(earlier)
                final[name] = F.coalesce(F.col(here) + F.col(moved), F.col(here), F.col(moved))
            elif kind is MaxBefore:
                local[here] = F.max(step.expr).over(before)
                summary[total] = F.max(step.expr)
                carry[moved] = F.max(total).over(earlier)
                final[name] = F.greatest(here, moved)
            elif kind is LastKnown:
                local[here] = F.last(step.expr, ignorenulls=True).over(so_far)
                summary[total] = at_edge(F.max_by, step.expr, F.when(step.expr.isNotNull(), rank), True)
                carry[moved] = F.last(total, ignorenulls=True).over(earlier)
                final[name] = F.coalesce(here, moved)
            elif kind in (Previous, Following):
                beside, edge = (F.lag, F.max_by) if kind is Previous else (F.lead, F.min_by)
                local[here] = beside(step.expr).over(inside)
                local[f"__has_{name}"] = beside(F.lit(True)).over(inside)
                summary[total] = at_edge(edge, step.expr, rank)
                carry[moved] = beside(total).over(across)
                final[name] = F.when(F.col(f"__has_{name}"), F.col(here)).otherwise(F.col(moved))
            elif kind is GroupSum:
                summary[total] = F.sum(step.expr)
                carry[moved] = F.sum(total).over(whole)
                final[name] = F.col(moved)
            elif kind is GroupMax:
                summary[total] = F.max(step.expr)
                carry[moved] = F.max(total).over(whole)
                final[name] = F.col(moved)
            elif kind is GroupLast:
                summary[total] = at_edge(F.max_by, step.expr, F.when(step.expr.isNotNull(), rank), True)
                carry[moved] = F.last(total, ignorenulls=True).over(whole)
                final[name] = F.col(moved)
            elif kind is Opener:
                # Of the openers of a bucket that an earlier end still reaches, the last is the latest to start: if
                # it is reached, all are, and the island carried in goes on.
                def free(opener: Column, reach: Column, gap=step.gap) -> Column:
                    return ~F.coalesce(opener["start"] <= reach + gap, F.lit(False))

                own = F.struct(step.expr.alias("start"), F.struct(*self.order).alias("at"))
                df = df.withColumn(f"__r_{name}", F.max(step.end).over(before))
                df = df.withColumn(here, F.last(F.when(free(own, F.col(f"__r_{name}")), own), ignorenulls=True).over(so_far))
                summary[total] = at_edge(F.max_by, F.col(here), rank)
                summary[f"__e_{name}"] = F.max(step.end)
                carry[f"__m_{name}"] = F.max(f"__e_{name}").over(earlier)
                carry[total] = F.col(total)
                second[moved] = F.last(F.when(free(F.col(total), F.col(f"__m_{name}")), F.col(total)["at"]), ignorenulls=True).over(earlier)
                final[name] = F.when(free(F.col(here), F.col(f"__m_{name}")), F.col(here)["at"]).otherwise(F.col(moved))
            else:
                raise TypeError(f"unknown step {kind.__name__}")

        totals = df.groupBy(*place).agg(*[value.alias(key) for key, value in summary.items()])
        carried = totals.select(*place, *[value.alias(key) for key, value in carry.items()])
        if second:
            carried = carried.select(
                *[c for c in carried.columns if c not in summary], *[value.alias(key) for key, value in second.items()]
            )
        rows = df.select("*", *[value.alias(key) for key, value in local.items()])
        return rows.join(carried, place).select(
            *[F.col(name) for name in kept], *[value.alias(key) for key, value in final.items()]
        )


def ordered_scan(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str], *steps: Step) -> DataFrame:
    """Run ``steps`` and drop the helper bucket column again."""
    scan = OrderedScan(tuple(keys), "__bucket", tuple(order))
    return scan.extend(df.withColumn("__bucket", bucket), *steps).drop("__bucket")
