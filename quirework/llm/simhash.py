"""SimHash near-duplicates over a byte-position inverted index.

Fingerprints that differ in at most 3 bits differ in at most 3 of their 8 bytes, so they share at
least 5 bytes at the same positions.  That guaranteed count is the filter.  A posting of the index is a choice of 4
positions with the 4 bytes found there (70 choices), so the pairs that share 4 or more positional bytes meet; of
each pair met the shared bytes are tallied, those with fewer than 5 go, and the rest are verified.  Single positions
would have lists of N / 256 fingerprints; these have lists of N / 2 ** 32.

Postings hold distinct fingerprints, so copies of a text are one entry.  Inside a posting the shared
bytes and differing bits are counted and only a spanning forest of the verified links goes out, which
keeps every component and never all pairs.  A long posting, whose fingerprints differ only in its
32 free bits, looks up the 5,488 ways of flipping at most 3 of them instead of comparing pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.common import query, stored, table, text_bytes
from quirework.llm.components import components

SHINGLE, MAX_BITS, SHARED_BYTES, SEED = 3, 3, 5, 42
#: Positions of a posting: one fewer than the count that the filter asks for.
KEY_BYTES = 4
CHOICES = list(combinations(range(8), KEY_BYTES))
FREE_BITS = 8 * (8 - KEY_BYTES)
#: Postings longer than this look up neighbours instead of comparing pairs; both give the same links.
PAIRWISE = 2048


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles of a text, each occurrence counted."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = [0, *(blanks[: len(words) - shingle] + 1).tolist()]
        ends = [*blanks[shingle - 1 :].tolist(), len(joined)]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(text.as_py()) for text in batch.column("bytes")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(prints, pa.int64())], ["doc_id", "digest", "fp"])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("fp").to_numpy()
        parts = prints.astype("<i8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        keys = []
        for number, choice in enumerate(CHOICES):
            key = np.full(len(prints), number, np.int64)
            for position in choice:
                key = (key << 8) | parts[:, position]
            keys.append(key)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(keys)),
                pa.array(np.tile(prints, len(CHOICES))),
            ],
            ["posting", "fp"],
        )


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Count filter on shared positional bytes, then the exact distance."""
    differing = a ^ b
    shared = 8 - np.count_nonzero(differing[..., None].view(np.uint8), axis=-1)
    return (shared >= SHARED_BYTES) & (np.bitwise_count(differing) <= MAX_BITS)


class _Forest:
    """Spanning forest over the members 0..n-1 of one posting."""

    def __init__(self, n: int) -> None:
        self.root, self.tree = np.arange(n), []

    def _find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = x = root[root[x]]
        return int(x)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        apart = self.root[i] != self.root[j]
        if not apart.any():
            return
        for x, y in zip(i[apart].tolist(), j[apart].tolist()):
            low, high = sorted((self._find(x), self._find(y)))
            if low != high:
                self.root[high] = low
                self.tree.append((x, y))
        while (self.root != (up := self.root[self.root])).any():
            self.root = up


def _masks() -> np.ndarray:
    return np.array([sum(1 << b for b in c) for n in range(1, MAX_BITS + 1) for c in combinations(range(FREE_BITS), n)], np.uint64)


def _spread(masks: np.ndarray, posting: int) -> np.ndarray:
    """Masks laid over the byte positions that a posting leaves free."""
    free = sorted(set(range(8)) - set(CHOICES[posting >> 8 * KEY_BYTES]))
    out = np.zeros_like(masks)
    for k, position in enumerate(free):
        out |= ((masks >> np.uint64(8 * k)) & np.uint64(255)) << np.uint64(8 * position)
    return out


def links_of(prints: np.ndarray, posting: int, pairwise: int = PAIRWISE) -> list[tuple[int, int]]:
    """Index pairs of a spanning forest over the links in one posting; ``prints`` ascending and distinct."""
    forest, n = _Forest(len(prints)), len(prints)
    if n <= pairwise:
        step = max(1, 1_000_000 // n)
        for at in range(0, n, step):
            i, j = np.nonzero(_close(prints[at : at + step, None], prints[None, :]))
            ahead = j > i + at
            forest.add(i[ahead] + at, j[ahead])
    else:
        for mask in _spread(_masks(), posting):
            other = prints ^ mask
            at = np.minimum(np.searchsorted(prints, other), n - 1)
            i = np.flatnonzero((prints[at] == other) & (at > np.arange(n)))
            forest.add(i, at[i])
    return forest.tree


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (posting, fp): runs of one posting, carried over batch borders."""
    held: list[tuple[np.ndarray, ...]] = []

    def solve(posting, prints):
        reps = prints.view(np.int64)
        starts = np.flatnonzero(np.r_[True, posting[1:] != posting[:-1]])
        sizes = np.diff(np.r_[starts, len(posting)])
        two = starts[sizes == 2]
        near = two[_close(prints[two], prints[two + 1])]
        u, v = [reps[near]], [reps[near + 1]]
        for at, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            order = at + np.argsort(prints[at : at + size])
            tree = np.array(links_of(prints[order], int(posting[at])), np.int64).reshape(-1, 2)
            u.append(reps[order[tree[:, 0]]])
            v.append(reps[order[tree[:, 1]]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])

    for batch in batches:
        now = tuple(batch.column(c).to_numpy() for c in ("posting", "fp"))
        if not len(now[0]):
            continue
        held.append((now[0], now[1].view(np.uint64)))
        if held[0][0][0] == now[0][-1]:
            continue  # one posting goes on over the whole batch
        posting, prints = (np.concatenate(x) for x in zip(*held))
        cut = np.searchsorted(posting, posting[-1])
        held = [(posting[cut:], prints[cut:])]
        yield solve(posting[:cut], prints[:cut])
    if held:
        yield solve(*(np.concatenate(x) for x in zip(*held)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id``, and ``digest`` (SHA-256 of the text) and ``root``, a
    number that the documents of a component share, with or without a doc_id.

    Null and wordless texts have fingerprint 0 and link like any other.  Rows that repeat a doc_id share
    a component if their fingerprints link.  A null doc_id links like any other; ``component_id`` is the smallest doc_id of the
    component, null if none of its rows has one.  Other columns are ignored, so their names cannot clash.
    """
    text = text_bytes()
    read = docs.select("doc_id", F.sha2(text, 256).alias("digest"), text.alias("bytes"))
    prints = stored(read.mapInArrow(_fingerprints, "doc_id long, digest string, fp long"))
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = classes.select("fp").mapInArrow(_postings, "posting long, fp long").repartition(parts, "posting").sortWithinPartitions("posting")
    tree = components(index.mapInArrow(_links, "u long, v long")).select(F.col("u").alias("fp"), F.col("v").alias("low"))
    rooted = stored(classes.join(tree, "fp", "left").select("fp", "rep", F.coalesce("low", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    placed = stored(rooted.select("fp", "root").join(least, "root"))
    return prints.join(placed, "fp").select("doc_id", "fp", "component_id", "digest", "root")


@query()
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
