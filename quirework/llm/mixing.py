"""Mixing sources to target weights by systematic sampling, with expressions only.

A source's documents stand in the order (size class, hash of the id).  Each is expected target / size
times, the prefix sums of these plus one random offset per source cross whole numbers, and a document is
taken once for each number crossed.  As the order goes by size, the words taken differ from the
target by at most about one of its longest documents.  A place in that order is a count of the rows before, found from
counts per (source, size class, 2 hash digits) and a row number inside such a cell, so no source is
walked by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.llm.common import query, stored, table

WEIGHTS, SHARE, LIMIT, SEED = (3, 1, 2), 1.5, 2, "mix"
_BLANK = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    marked = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), _BLANK, " "))
    return F.when(marked == "", 0).otherwise(F.char_length(marked) - F.char_length(F.replace(marked, F.lit(" "), F.lit(""))) + 1).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """``(source, source_size)`` to the same with ``target``; one row per source goes in.

    The sources stand by their limit per weight.  While the ones before are held at their limits, what is left
    per weight rises; once an unheld one is passed it falls.  Its maximum is thus the common level, and
    a source gets its weight times that level or its limit.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int")).cast("long")
    ranked = sizes.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * limit).alias("most"))
    ratio = F.col("most") / F.col("weight")
    before = Window.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    words = F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0))
    left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = ranked.select("*", (words / left).alias("level"))
    level = level.select("*", F.max("level").over(whole).alias("top"))
    return level.select("source", "source_size", F.least(F.col("most").cast("double"), F.col("top") * F.col("weight")).alias("target"))


def size_class(size: Column) -> Column:
    """Whole number that does not fall as the size rises: the length in bits and the first 6 bits."""
    bits = F.length(F.bin(size))
    return (bits * 64 + F.floor(size / F.pow(F.lit(2.0), F.greatest(bits - 6, F.lit(0))))).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, limit: int = LIMIT, seed: str = SEED) -> DataFrame:
    """``docs(doc_id, source, size)`` to those with ``source_size, target, copies``; reruns agree.

    A null source is a source of its own, last in order; sizes of 0 are taken at their source's rate; ties and
    repeated ids stand side by side.  No document is taken more than ``limit`` times.
    """
    name = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = docs.select("doc_id", "source", "size", name.alias("name"), size_class(F.col("size")).alias("class"))
    rows = stored(rows.select("*", F.substring("name", 1, 2).alias("digits"), F.coalesce("source", F.lit("")).alias("key"), F.col("source").isNull().alias("none")))
    place = ["key", "none", "class"]
    cells = rows.groupBy(*place, "digits").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*place).orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    within = cells.select(*place, "digits", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("within"))
    lower = Window.partitionBy("key", "none").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    below = cells.groupBy(*place).agg(F.sum("n").alias("n")).select(*place, F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("below"))
    aims = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, limit)
    aims = aims.select(F.coalesce("source", F.lit("")).alias("key"), F.col("source").isNull().alias("none"), "source_size", "target")
    steps = stored(within.join(below, place).join(aims, ["key", "none"]))
    cell = Window.partitionBy(*place, "digits").orderBy("name", "doc_id", "size")
    placed = rows.withColumn("row", F.row_number().over(cell)).join(steps, [*place, "digits"])
    mark = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.when(F.col("none"), "1").otherwise("0"), F.col("key")).cast("binary")), 1, 8), 16, 10)
    offset = mark.cast("double") / F.lit(4294967296.0)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rank = F.col("below") + F.col("within") + F.col("row")
    copies = F.floor(rank * rate + offset) - F.floor((rank - 1) * rate + offset)
    return placed.select("doc_id", "source", "size", "source_size", "target", F.least(copies, F.lit(limit)).cast("long").alias("copies"))


_SQL = r"""
with docs as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents),
sizes as (select source, cast(sum(size) as bigint) as source_size from docs group by 1),
weighed as (
  select *, [3, 1, 2][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as bigint)] as weight, source_size * 2 as most
  from sizes),
levels as (
  select *, ((sum(source_size) over () * 1.5::double) - coalesce(sum(most) over w, 0)::double)
    / (sum(weight) over () - coalesce(sum(weight) over w, 0))::double as level
  from weighed window w as (order by most / weight, source nulls last rows between unbounded preceding and 1 preceding)),
aims as (select source, source_size, least(most::double, max(level) over () * weight) as target from levels),
named as (
  select *, md5('mix' || coalesce(cast(doc_id as varchar), '')) as name, length(bin(size)) as bits from docs),
ranked as (
  select *, row_number() over (
    partition by source
    order by bits * 64 + floor(size / pow(2.0, greatest(bits - 6, 0))), name, doc_id, size) as rank
  from named),
rated as (
  select r.*, source_size, target, case when source_size > 0 then target / source_size else 0.0 end as rate,
    cast('0x' || substr(md5('mix' || (case when r.source is null then '1' else '0' end) || coalesce(r.source, '')), 1, 8) as bigint)
      / 4294967296.0::double as shift
  from ranked r join aims a on r.source is not distinct from a.source)
select doc_id, size, source_size, target,
  cast(least(floor(rank * rate + shift) - floor((rank - 1) * rate + shift), 2) * size as bigint) as taken
from rated
"""


@query(_SQL)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    mixed = mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
