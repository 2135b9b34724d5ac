"""Exact deduplication over an extendible-hash index in the shared folder.

Keys are 64-bit hashes of the normalised texts.  The directory doubles until no bucket holds more than
its capacity of distinct text (counted per leading hash bits in Spark), and names the bucket for each
leading bit pattern.  Each map task first chains its own rows, comparing bytes, so a text in a third of
the rows arrives once per task.  An owner task holds whole buckets, in the order of the hash:
rows with one hash form a chain of different texts, each compared byte by byte.  The finished
index, one row per text, is a table of the shared folder; documents look up their row in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.common import BLANKS, query, stored, table

#: Bytes of distinct text per bucket, leading hash bits that are counted, bytes a map task holds before it sends.
BUCKET_BYTES, MOST_BITS, HELD_BYTES = 4_000_000, 16, 16_000_000

_CHAINED = "hash long, digest string, text binary, n long, points long, keep_id long"


def directory(weights: dict[int, int], bits: int, capacity: int) -> tuple[int, list[tuple[int, int, int]]]:
    """``weights`` of the 2**bits leading bit patterns to (global depth, [(slot, bucket, local depth)]).

    The directory begins with one bucket.  An overfull bucket splits by one more bit; if its depth is that of the
    directory, the directory doubles.  A bucket still overfull at ``bits`` keeps its overflow.
    """
    sums = [0, *accumulate(weights.get(i, 0) for i in range(1 << bits))]
    depth, slots = 0, [(0, 0)]  # per slot: local depth, leading bits of its bucket

    def weight(local: int, lead: int) -> int:
        return sums[(lead + 1) << (bits - local)] - sums[lead << (bits - local)]

    while True:
        over = [(d, lead) for d, lead in dict.fromkeys(slots) if d < bits and weight(d, lead) > capacity]
        if not over:
            break
        if any(d == depth for d, _ in over):
            slots, depth = [s for s in slots for _ in range(2)], depth + 1
        full = set(over)
        slots = [(d + 1, i >> (depth - d - 1)) if (d, lead) in full else (d, lead) for i, (d, lead) in enumerate(slots)]
    return depth, [(i, lead << (depth - d), d) for i, (d, lead) in enumerate(slots)]


class _Chains:
    """Texts by hash; texts that share one are chained and told apart by their bytes."""

    def __init__(self) -> None:
        self.chains: dict[int, list[list]] = {}
        self.bytes = 0

    def add(self, key: int, digest: str, text: bytes, n: int, points: int, keep: int | None) -> None:
        chain = self.chains.setdefault(key, [])
        for link in chain:
            if link[1] == text:
                link[2] += n
                if (points, _last(keep)) > (link[3], _last(link[4])):
                    link[3:] = [points, keep]
                return
        chain.append([digest, text, n, points, keep])
        self.bytes += len(text) + 200

    def rows(self, texts: bool) -> pa.RecordBatch:
        flat = [(k, c[0], c[1] if texts else None, *c[2:]) for k, chain in self.chains.items() for c in chain]
        types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*flat)) or [()] * 6
        names = [x.split()[0] for x in _CHAINED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _last(keep: int | None) -> int:
    """Of rows with equally many code points the smallest id stays; a null id is the last choice."""
    return -(1 << 63) if keep is None else -keep


def _columns(batch: pa.RecordBatch):
    return zip(*(batch.column(c).to_pylist() for c in ("hash", "digest", "text", "n", "points", "keep_id")))


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Chains()
    for batch in batches:
        for row in _columns(batch):
            held.add(*row)
        if held.bytes > HELD_BYTES:
            yield held.rows(True)
            held = _Chains()
    yield held.rows(True)


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket and hash, so a chain is finished when the next hash begins."""
    held, last = _Chains(), None
    for batch in batches:
        for row in _columns(batch):
            if row[0] != last and held.bytes > HELD_BYTES:
                yield held.rows(False)
                held = _Chains()
            last = row[0]
            held.add(*row)
    yield held.rows(False)


def dedup_exact(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, digest`` (SHA-256 of the normalised text).

    Null counts as empty; texts are equal if their bytes are, blanks removed.  The row with the most code
    points, then the smallest doc_id stays; a null doc_id is the last choice.  Rows that repeat both are
    ties, of which each has ``kept`` true.  Other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    plain = F.translate(text, BLANKS, "")
    rows = docs.select(
        F.xxhash64(plain).alias("hash"), F.sha2(plain, 256).alias("digest"), plain.cast("binary").alias("text"),
        F.lit(1).cast("long").alias("n"), F.char_length(text).cast("long").alias("points"), F.col("doc_id").alias("keep_id"),
    )
    keys = stored(rows.select("hash", "digest", F.length("text").cast("long").alias("bytes"), "points", F.col("keep_id").alias("doc_id")))
    lead = F.shiftrightunsigned("hash", 64 - MOST_BITS)
    counted = keys.groupBy("hash").agg(F.max("bytes").alias("bytes")).groupBy(lead.alias("lead")).agg(F.sum("bytes").alias("bytes"))
    depth, slots = directory({r["lead"]: r["bytes"] for r in counted.collect()}, MOST_BITS, bucket_bytes)
    spark = docs.sparkSession
    names = F.broadcast(spark.createDataFrame(slots, "slot long, bucket long, depth int"))  # 2**MOST_BITS rows at most
    slot = F.shiftrightunsigned("hash", 64 - depth) if depth else F.lit(0).cast("long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pages = rows.mapInArrow(_send, _CHAINED).withColumn("slot", slot).join(names, "slot")
    owned = pages.repartition(parts, "bucket").sortWithinPartitions("bucket", "hash")
    index = stored(owned.select(*[x.split()[0] for x in _CHAINED.split(", ")]).mapInArrow(_own, _CHAINED).drop("text"))
    found = keys.join(index.select("hash", "digest", "n", "keep_id", F.col("points").alias("most")), ["hash", "digest"])
    return found.select(
        "doc_id", "keep_id", F.col("n").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("most"))).alias("kept"), "digest",
    )


_SQL = r"""
with plain as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as t, length(coalesce(text, '')) as points
  from documents),
ranked as (
  select *, first_value(doc_id) over (partition by t order by points desc, doc_id) as keep_id, count(*) over (partition by t) as n
  from plain)
select doc_id, keep_id, n as group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from ranked
"""


@query(_SQL)
def op3_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_exact(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.withColumnRenamed("digest", "text_sha256")
