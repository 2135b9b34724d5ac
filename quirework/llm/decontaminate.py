"""Benchmark decontamination by Wu-Manber search over words.

Each benchmark item gives patterns of 10 consecutive words (a shorter item is one pattern).  Patterns
of one length m share a set of tables over blocks of up to 3 words: a shift table that tells how far the
window may move when its last block is not the end of a pattern, buckets of patterns by that last
block, and inside a bucket by the first word; what is left is compared word by word.
The documents are read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.common import query, stored, table, text_bytes

WINDOW, BLOCK = 10, 3
#: Bytes of benchmark text searched in one pass; a larger benchmark takes several passes.
PASS_BYTES = 16_000_000

#: Word characters are 0-9, a-z and everything beyond ASCII; A-Z count as a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


class Tables:
    """Shift and bucket tables for the patterns of one length."""

    def __init__(self, length: int) -> None:
        self.length, self.block = length, min(BLOCK, length)
        self.items: dict[tuple[bytes, ...], set[int]] = {}
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[bytes, list[tuple[bytes, ...]]]] = {}

    def add(self, pattern: tuple[bytes, ...], item: int) -> None:
        if pattern in self.items:
            self.items[pattern].add(item)
            return
        self.items[pattern] = {item}
        m, b = self.length, self.block
        for end in range(b, m + 1):
            piece = pattern[end - b : end]
            if self.shift.get(piece, m) > m - end:
                self.shift[piece] = m - end
        self.buckets.setdefault(pattern[m - b :], {}).setdefault(pattern[0], []).append(pattern)

    def search(self, words: list[bytes], hit: np.ndarray, found: set[int]) -> None:
        m, b, n = self.length, self.block, len(words)
        shift, buckets, skip = self.shift.get, self.buckets, self.length - self.block + 1
        end = m
        while end <= n:
            last = tuple(words[end - b : end])
            move = shift(last, skip)
            if move:
                end += move
                continue
            start = end - m
            for pattern in buckets[last].get(words[start], ()):
                if tuple(words[start:end]) == pattern:
                    hit[start:end] = True
                    found |= self.items[pattern]
            end += 1


def build(items: list[tuple[int | None, bytes | None]], window: int = WINDOW) -> list[Tables]:
    tables: dict[int, Tables] = {}
    for item, text in items:
        words = words_of(text)
        m = min(window, len(words))
        for at in range(len(words) - m + 1 if m else 0):
            tables.setdefault(m, Tables(m)).add(tuple(words[at : at + m]), item)
    return list(tables.values())


SCHEMA = "doc_id long, bytes binary, n_words long, n_hit long, hits binary, item_ids array<long>"


def _searcher(shared):
    types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    names = ["doc_id", "bytes", "n_words", "n_hit", "hits", "item_ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = build(shared.value)
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            before = zip(batch.column("bytes"), batch.column("hits").to_pylist(), batch.column("item_ids").to_pylist())
            for text, hits, ids in before:
                words = words_of(text.as_py())
                hit = np.zeros(len(words), bool)
                if hits:
                    hit |= np.unpackbits(np.frombuffer(hits, np.uint8), count=len(words)).astype(bool)
                found = set(ids)
                for one in tables:
                    one.search(words, hit, found)
                columns[0].append(len(words))
                columns[1].append(int(hit.sum()))
                columns[2].append(np.packbits(hit).tobytes())
                columns[3].append(sorted(found, key=lambda x: (x is None, x or 0)))
            made = [pa.array(v, t) for v, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("bytes"), *made], names)

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """One row per document: ``doc_id, bytes`` (UTF-8 of the text), ``n_words, n_hit, hits`` (a bit per word)
    and ``item_ids``, the items found in it.

    A null or wordless text has no words; an item without words is never found; items that repeat an id
    count as one, a null id as one more.  Other columns are ignored.  The benchmark is streamed to the driver in
    passes of at most ``pass_bytes`` of text (one item at least), whose tables are broadcast; with
    several passes, the documents and what was found so far are stored in the shared folder in between.
    """
    context = docs.sparkSession.sparkContext
    state = docs.select(
        "doc_id", text_bytes().alias("bytes"), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
        F.lit(b"").alias("hits"), F.array().cast("array<long>").alias("item_ids"),
    )
    held: list[tuple[int | None, bytes]] = []
    size = 0
    for row in benchmark.select("item_id", text_bytes().alias("bytes")).toLocalIterator():
        text = bytes(row["bytes"])
        if held and size + len(text) > pass_bytes:
            state = stored(state.mapInArrow(_searcher(context.broadcast(held)), SCHEMA))
            held, size = [], 0
        held.append((row["item_id"], text))
        size += len(text)
    return state.mapInArrow(_searcher(context.broadcast(held)), SCHEMA)


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_SQL = f"""
with items as (select item_id, {_WORDS} as w from benchmark),
patterns as (
  select distinct item_id, least(len(w), 10) as m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as p
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)),
lengths as (select distinct m from patterns),
words as (select doc_id, {_WORDS} as w from documents),
windows as (
  select doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') as p
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from words, lengths where len(w) >= m)),
met as (select doc_id, i, x.m, item_id from windows join patterns x using (m, p)),
hits as (
  select doc_id, count(distinct k) as n_hit from (select distinct doc_id, unnest(range(i, i + m)) as k from met) group by 1),
found as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from met) group by 1)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hits using (doc_id) left join found using (doc_id)
"""


@query(_SQL)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("item_ids", lambda x: x.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
