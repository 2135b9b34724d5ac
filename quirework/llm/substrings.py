"""Exact substring deduplication by Rabin-Karp hashes of every window of 13 words.

Documents are dealt to blocks of neighbouring doc_ids; stretches of ids that hold too much text are cut
finer until they fit, and the rows of one id are sliced by their text.  A block hashes every window of its
texts in one pass of prefix sums and sends each different hash once, packed per range of the hash
space; the task of a range finds, for each hash, the first block that has it, and answers each
block with one bit per hash.  A passage in a third of the corpus thus costs one entry per block.  The
block then knows which windows started in a document with a smaller id, merges them into maximal intervals
of words, and cuts.

Two polynomial hashes of 64 bits are taken.  Inside a block all 128 bits count; between blocks one whole
hash, 16 bits of the other and the range, whose number grows with the input: 80 bits and more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.common import query, stored, table, text_bytes

WINDOW = 13
#: Text per block of documents and hashed windows per range.
BLOCK_BYTES, RANGE_WINDOWS = 4_000_000, 2_500_000
#: A block with this many times its share of text is cut into so many stretches.
OVERFULL, FINER = 8, 1024
#: The id and block of rows without one.
TOP = (1 << 63) - 1
#: Windows hashed at a time, which bounds the memory for a very long text.
STEP = 200_000
#: Odd bases of the two hashes and their inverses modulo 2**64.
BASES = (0x5851F42D4C957F2D, 0x2545F4914F6CDD1D)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads the hash over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bounds(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of words joined by single blanks."""
    if not joined:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return np.r_[0, blanks + 1], np.r_[blanks, len(joined)]


def window_hashes(joined: bytes, starts: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of every window, from prefix sums of byte * base**-i."""
    n = len(starts) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    found: tuple[list, list] = ([], [])
    data = np.frombuffer(joined, np.uint8)
    for at in range(0, n, STEP):
        first, last = starts[at : min(at + STEP, n)], ends[at + window - 1 : min(at + STEP, n) + window - 1]
        low, high = int(first[0]), int(last[-1])
        piece = data[low:high].astype(np.uint64)
        a, b = first - low, last - low
        for k, (base, inverse) in enumerate(zip(BASES, _INVERSES)):
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(piece * _power(inverse, len(piece)), out=sums[1:])
            found[k].append(_mixed((sums[b] - sums[a]) * _power(base, len(piece) + 1)[a]))
    return np.concatenate(found[0]), np.concatenate(found[1])


class Block:
    """The windows of the documents of one block, and its different hashes in their order."""

    def __init__(self, ids: np.ndarray, texts: list[bytes]) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.texts = [b" ".join(texts[i].split()) for i in order]
        self.bounds = [bounds(t) for t in self.texts]
        hashes = [window_hashes(t, *b) for t, b in zip(self.texts, self.bounds)]
        self.counts = [len(h) for h, _ in hashes]
        one = np.concatenate([h for h, _ in hashes] or [np.zeros(0, np.uint64)])
        two = np.concatenate([h for _, h in hashes] or [np.zeros(0, np.uint64)])
        doc = np.repeat(self.ids, self.counts)
        by = np.lexsort((two, one))
        one, two, doc = one[by], two[by], doc[by]
        new = np.ones(len(by), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        begin = np.flatnonzero(new)
        self.one, self.two = one[begin], two[begin]
        #: Of each window, the place of its hash, and whether a smaller document of the block has it.
        self.entry, self.later = np.empty(len(by), np.int64), np.empty(len(by), bool)
        self.entry[by] = np.cumsum(new) - 1
        self.later[by] = doc > (np.minimum.reduceat(doc, begin)[np.cumsum(new) - 1] if len(begin) else doc)

    def ranges(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Order of the hashes by range, and the range of each."""
        of = ((self.two >> np.uint64(16)) % np.uint64(n)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        return order, of[order]


def _ids(table_: pa.Table) -> np.ndarray:
    """A null doc_id counts as the largest."""
    return table_.column("doc_id").fill_null(TOP).to_numpy()


_ENTRY = pa.schema([("block", pa.int64()), ("slice", pa.int64()), ("range", pa.int64()), ("hashes", pa.binary())])
_PACKED = np.dtype([("one", "<u8"), ("two", "<u2")])


def _send(n_ranges: int):
    def run(group: pa.Table) -> pa.Table:
        block = Block(_ids(group), group.column("bytes").to_pylist())
        order, of = block.ranges(n_ranges)
        packed = np.empty(len(order), _PACKED)
        packed["one"], packed["two"] = block.one[order], block.two[order] & np.uint64(0xFFFF)
        begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
        parts = [x.tobytes() for x in np.split(packed, begin[1:])] if len(of) else []
        number, part = group.column("block")[0].as_py(), group.column("slice")[0].as_py()
        return pa.table([[number] * len(parts), [part] * len(parts), of[begin], parts], schema=_ENTRY)

    return run


_ANSWER = pa.schema([("block", pa.int64()), ("slice", pa.int64()), ("range", pa.int64()), ("n", pa.int64()), ("first", pa.binary())])


def _answer(group: pa.Table) -> pa.Table:
    """For each block's hashes of this range, whether the block is the first to have them."""
    blocks = group.column("block").to_numpy()
    parts = [np.frombuffer(x.as_py(), _PACKED) for x in group.column("hashes")]
    sizes = [len(x) for x in parts]
    every, block = np.concatenate(parts), np.repeat(blocks, sizes)
    by = np.lexsort((block, every["two"], every["one"]))
    one, two, block = every["one"][by], every["two"][by], block[by]
    new = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])]
    first = np.empty(len(by), bool)
    first[by] = block == block[np.flatnonzero(new)][np.cumsum(new) - 1]
    bits = [np.packbits(x).tobytes() for x in np.split(first, np.cumsum(sizes)[:-1])]
    return pa.table([blocks, group.column("slice"), group.column("range"), sizes, bits], schema=_ANSWER)


_CUT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())]
)


def _cut(n_ranges: int):
    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(_ids(group), group.column("bytes").to_pylist())
        order, _ = block.ranges(n_ranges)
        rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("range", "n", "first"))))
        first = np.ones(len(order), bool)
        if rows:
            first[order] = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for _, n, b in rows]).astype(bool)
        repeated = block.later | ~first[block.entry]
        made: list[list] = [[], [], [], []]
        at = 0
        for text, (starts, ends), count in zip(block.texts, block.bounds, block.counts):
            hit, at = repeated[at : at + count], at + count
            edges = np.zeros(len(starts) + 1, np.int64)
            where = np.flatnonzero(hit)
            np.add.at(edges, where, 1)
            np.add.at(edges, where + WINDOW, -1)
            gone = np.cumsum(edges[:-1]) > 0
            turn = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
            spans = turn.reshape(-1, 2)
            stay = np.r_[0, turn, len(starts)].reshape(-1, 2)
            kept = [text[starts[a] : ends[b - 1]] for a, b in stay.tolist() if b > a]
            for column, value in zip(made, (len(starts), int(gone.sum()), spans.tolist(), b" ".join(kept))):
                column.append(value)
        ids = pa.array(block.ids, mask=block.ids == TOP)
        return pa.table([ids, *made], schema=_CUT)

    return run


def _deal(docs: DataFrame, sizes: DataFrame, low: int, width: int, block_bytes: int) -> DataFrame:
    """``docs`` with ``block``, the first id of the stretch it falls in, and ``slice``, 0 but for overfull ids.

    ``sizes(doc_id, bytes)`` tells which stretches hold too much; those, usually none, are looked up by a join.
    """

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("block", F.coalesce(F.expr(f"{low} + (doc_id - {low}) div {width} * {width}"), F.lit(TOP)))

    def finer(df: DataFrame) -> DataFrame:
        inside = F.when(F.col("begin") < TOP, F.expr(f"begin + (doc_id - begin) div {width} * {width}"))
        return df.join(over.drop("slices"), F.col("block") == F.col("begin"), "left").withColumn("block", F.coalesce(inside, "block")).drop("begin")

    docs, sizes = placed(docs), placed(sizes)
    while True:
        held = sizes.groupBy(F.col("block").alias("begin")).agg(F.sum("bytes").alias("held")).filter(F.col("held") > OVERFULL * block_bytes)
        over = stored(held.select("begin", F.ceil(F.col("held") / block_bytes).alias("slices")))
        if over.isEmpty():
            return docs.withColumn("slice", F.lit(0).cast("long"))
        if width == 1:
            part = F.coalesce(F.pmod(F.xxhash64("bytes"), F.col("slices")), F.lit(0)).cast("long")
            return docs.join(over, F.col("block") == F.col("begin"), "left").withColumn("slice", part).drop("begin", "slices")
        width = max(1, width // FINER)
        docs, sizes = finer(docs), finer(sizes)


def dedup_substrings(docs: DataFrame, block_bytes: int = BLOCK_BYTES, range_windows: int = RANGE_WINDOWS) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, spans`` (removed words as [start, end) pairs, maximal
    and in order) and ``kept`` (UTF-8 of the words kept, joined by one blank).

    A null text has no words; a text of under 13 words loses none.  Rows that repeat a doc_id don't remove each
    other's words; a null doc_id counts as the largest.  Other columns are ignored.  A task holds at most
    ``OVERFULL`` blocks' worth of text, however the ids lie, or one longer text.
    """
    sizes = stored(docs.select("doc_id", F.octet_length("text").cast("long").alias("bytes")))
    state = sizes.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum("bytes").alias("bytes")).first()
    size = state["bytes"] or 0
    n_blocks = max(1, -(-size // block_bytes))
    n_ranges = max(1, size // 6 // range_windows)
    low, high = state["low"] or 0, state["high"] or 0
    dealt = _deal(docs.select("doc_id", text_bytes().alias("bytes")), sizes, low, (high - low) // n_blocks + 1, block_bytes)
    entries = dealt.groupBy("block", "slice").applyInArrow(_send(n_ranges), "block long, slice long, range long, hashes binary")
    answers = entries.groupBy("range").applyInArrow(_answer, "block long, slice long, range long, n long, first binary")
    return (
        dealt.groupBy("block", "slice")
        .cogroup(answers.groupBy("block", "slice"))
        .applyInArrow(_cut(n_ranges), "doc_id long, n_words long, n_removed long, spans array<array<long>>, kept binary")
    )


_SQL = r"""
with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, i, sha256(array_to_string(w[i:i + 12], ' ')) as h
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from words where len(w) >= 13)),
firsts as (select h, min(doc_id) as first from windows group by 1),
gone as (
  select distinct doc_id, unnest(range(i, i + 13)) as k from windows join firsts using (h) where first < doc_id),
cut as (select doc_id, list(k) as ks from gone group by 1)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(ks), 0) as bigint) as n_removed,
  sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda k: not list_contains(coalesce(ks, []), k)),
    lambda k: w[k]), ' '), '')) as kept_sha256
from words left join cut using (doc_id)
"""


@query(_SQL)
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_substrings(table(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
