"""Sharding by a minimax contiguous partition, with expressions only.

Equal texts form an atomic group; groups stand in the order of their text's digest.  Wanted are the cuts
into at most 16 runs whose largest run is smallest.  The smallest feasible capacity is found by binary
search with a greedy check; both run over sums per stretch of digests.  A group over an eighth of an equal share
(127 at most) is a stretch of its own, and those around it end there.  A first table has one sum per
4 hex digits, 65,536 at most whatever the input.  A stretch in which some cut could fall is replaced by its
own stretches of 3 more digits, until those that matter hold a single group; then the search
and the cuts are exact.  Only these sums come to the driver, a bounded number at a time.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.llm.common import query, stored, table

SHARDS, LAW = 16, "bytes"
FIRST_DIGITS, MORE_DIGITS = 4, 3
#: Signs before a digest that tell on which side of the heavy ones it lies.
MARK = 6
#: A group over 1 / HEAVY of an equal share stands alone; so many stretches, and sums inside them, are opened at a time.
HEAVY, OPENED, OPENED_SUMS = 8, 512, 1 << 18


class Stretch:
    """Groups whose marked digests begin alike: their number and sizes."""

    def __init__(self, prefix: str, size: int, groups: int, largest: int) -> None:
        self.prefix, self.size, self.groups, self.largest = prefix, size, groups, largest


def _ends(sums: list[int], capacity: int, shards: int) -> list[int]:
    """Greedy run ends (numbers of stretches) under a capacity; the last is short of all if it is too small."""
    ends, at = [], 0
    for _ in range(shards):
        at = max(at, bisect_right(sums, sums[at] + capacity) - 1)
        ends.append(at)
    return ends


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Binary search for the smallest capacity under which the greedy runs reach the end."""
    sums = [0, *accumulate(sizes)]
    low, high = max([0, *sizes, -(-sums[-1] // shards)]), sums[-1]
    while low < high:
        middle = (low + high) // 2
        if _ends(sums, middle, shards)[-1] == len(sizes):
            high = middle
        else:
            low = middle + 1
    return low


def _reaches(sums: list[int], alone: list[bool], capacity: int, shards: int) -> list[int]:
    """Where greedy runs end at most, in bytes: a stretch of several groups may be cut anywhere."""
    ends, at = [], 0
    for _ in range(shards):
        to = min(at + capacity, sums[-1])
        i = bisect_right(sums, to) - 1
        at = max(at, sums[i] if i < len(alone) and alone[i] else to)
        ends.append(at)
    return ends


def _open(stretches: list[Stretch], shards: int) -> list[int]:
    """Stretches of several groups in which a cut of the best partition may fall, a bounded number of them.

    Its capacity is at least the smallest with every stretch of several groups split at will, and at most that
    for whole stretches.  The end of run k lies between the greedy ends under these two.  Where this
    leaves too many, those for the capacity in the middle are opened in the order of the runs.
    """
    sizes, alone = [s.size for s in stretches], [s.groups == 1 for s in stretches]
    sums = [0, *accumulate(sizes)]
    low, most = max([0, *(s.largest for s in stretches), -(-sums[-1] // shards)]), smallest_capacity(sizes, shards)
    high = most = max(low, most)
    while low < high:
        middle = (low + high) // 2
        if _reaches(sums, alone, middle, shards)[-1] == sums[-1]:
            high = middle
        else:
            low = middle + 1

    def between(least: int, most: int) -> list[int]:
        ends = zip(_ends(sums, least, shards), _reaches(sums, alone, most, shards))
        return list(dict.fromkeys(i for early, late in ends for i in range(early, bisect_left(sums, late)) if not alone[i]))

    def cost(found: list[int]) -> list[int]:
        return list(accumulate(min(stretches[i].groups, 16**MORE_DIGITS) for i in found))

    found = between(low, most)
    if len(found) > OPENED or (found and cost(found)[-1] > OPENED_SUMS):
        found = between((low + most) // 2, (low + most) // 2)
        found = found[: max(1, min(OPENED, bisect_right(cost(found), OPENED_SUMS)))]
    return sorted(found)


def _marked(heavy: list[str]) -> Column:
    """The digest after the number of heavy digests up to it and below it, so that no stretch holds a heavy one and others."""
    rank = sum(((F.col("digest") >= h).cast("int") + (F.col("digest") > h).cast("int") for h in heavy), F.lit(0))
    return F.concat(F.lpad(rank.cast("string"), MARK, "0"), "digest")


def cuts(groups: DataFrame, shards: int = SHARDS) -> list[str]:
    """First digests of the second and later runs; ``groups(digest, size)`` has a row per group.

    A bound may be a digest's beginning, or a heavy digest with one more sign to begin behind it.
    """
    total = groups.agg(F.sum("size").alias("size")).first()["size"] or 0
    heavy = sorted(r["digest"] for r in groups.filter(F.col("size") * (HEAVY * shards) > total).select("digest").collect())
    marked = groups.select(_marked(heavy).alias("mark"), "size")

    def level(df: DataFrame, digits: int) -> list[Stretch]:
        part = df.groupBy(F.substring("mark", 1, digits).alias("prefix")).agg(
            F.sum("size").alias("size"), F.count("*").alias("groups"), F.max("size").alias("largest")
        )
        return [Stretch(r["prefix"], r["size"], r["groups"], r["largest"]) for r in part.collect()]

    def first(mark: str) -> str:
        rank, prefix = int(mark[:MARK]), mark[MARK:]
        if rank % 2:
            return heavy[rank // 2]
        return max(prefix, heavy[rank // 2 - 1] + "0") if rank else prefix

    stretches = sorted(level(marked, MARK + FIRST_DIGITS), key=lambda s: s.prefix)
    while opened := set(_open(stretches, shards)):
        finer, again = [s for i, s in enumerate(stretches) if i not in opened], {}
        for i in opened:
            again.setdefault(len(stretches[i].prefix), []).append(stretches[i].prefix)
        for length, prefixes in again.items():
            finer += level(marked.filter(F.substring("mark", 1, length).isin(prefixes)), length + MORE_DIGITS)
        stretches = sorted(finer, key=lambda s: s.prefix)
    sizes = [s.size for s in stretches]
    ends = _ends([0, *accumulate(sizes)], smallest_capacity(sizes, shards), shards)
    return [first(stretches[e].prefix) for e in dict.fromkeys(ends) if e < len(stretches)]


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: ``doc_id, digest, size, crc, shard, slot``.

    A null text is an empty one, of size 1; equal texts share a shard; slots of a shard run from 0 without
    gaps, in no particular order, and reruns agree; with fewer groups than shards, some stay empty.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select(
            "doc_id", F.sha2(text, 256).alias("digest"), (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"), F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 3).alias("cell"),
        )
    )
    groups = stored(rows.groupBy("digest").agg(F.sum("size").alias("size")))
    number = sum((F.when(F.col("digest") >= cut, 1).otherwise(0) for cut in cuts(groups, shards)), F.lit(0))
    dealt = rows.select("*", number.cast("int").alias("shard"))
    counts = dealt.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    row = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "digest"))
    placed = dealt.select("*", row.alias("row")).join(base, ["shard", "cell"])
    return placed.select("doc_id", "digest", "size", "crc", "shard", (F.col("base") + F.col("row") - 1).cast("long").alias("slot"))


@query()
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(table(spark, sf_dir, "documents", "doc_id", "text"))
    return placed.select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
