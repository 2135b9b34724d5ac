"""Phrase collocations from count streams in prefix and suffix order.

Counts of phrases of 1 to 3 words are streams of (key, count) records, sorted.  In prefix order a phrase comes right
after the phrases it begins with, in suffix order (its words reversed) right after those it ends with.  One walk
over each stream therefore meets every phrase with the counts of its parts in hand: the left parts and the right
extensions in prefix order, the right parts and the left extensions in suffix order.  Nothing is looked up in a table.

A key is the language followed by the words, so the language alone, the phrase of no words, carries the number of all
words.  Streams are cut into ranges at the two-word keys of a bounded sample; a range
also gets the records of the language and of the one word that reach into it.

Only phrases whose parts are frequent can be: three-word phrases are counted where both their pairs pass a bit table
of a fixed size, which lets some others through and stops none that counts.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.llm.common import hashed_share, query, stored, table, text_bytes

LONGEST, LEAST, TOP = 3, 10, 2000
#: A candidate goes if a longer one that holds it has at least so many hundredths of its count.
COVERED = 50
SCALE = 1_000_000
#: Pieces end at these characters; words at blanks and tabs.
_FOLD = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
#: Words counted together in a task, and bytes of text split together.
BUFFER, CHUNK = 500_000, 1_000_000
#: Bits of the table of frequent pairs, and rows of the sample that ranges are cut by.
TABLE_BITS, SAMPLE = 25, 20_000
GAP = b"\x00\x00"
MARKS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)


def escaped(word: bytes) -> bytes:
    """A word inside a key: joined by GAP, keys sort as their lists of words do."""
    return word.replace(b"\x00", b"\x00\x01") if b"\x00" in word else word


def restored(word: bytes) -> bytes:
    return word.replace(b"\x00\x01", b"\x00")


def word_mark(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang + GAP + word, 11)


def pair_places(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Places of pairs of words in the bit table, by the marks of the words."""
    x = first * MARKS[0] + (second ^ (second >> np.uint64(29))) * MARKS[1]
    x = (x ^ (x >> np.uint64(32))) * MARKS[2]
    return x >> np.uint64(64 - TABLE_BITS)


def _slices(keys, counts: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray]]:
    for at in range(0, len(counts), 20_000):
        part = slice(at, at + 20_000)
        yield keys(part), counts[part]


class _Counter:
    """Words of one language as codes, until there are enough to be counted together."""

    def __init__(self, lang: bytes) -> None:
        self.lang, self.texts, self.bytes, self.words = lang, [], 0, 0
        self.codes, self.known, self.names = [], {}, []

    def add(self, text: bytes) -> None:
        self.texts.append(text)
        self.bytes += len(text)
        if self.bytes >= CHUNK:
            self.encode()

    def encode(self) -> None:
        joined = b" \n ".join([*self.texts, b""]).lower().translate(_FOLD).replace(b"\n", b" \n ")
        self.texts, self.bytes = [], 0
        found = pa.array(joined.split(b" "), pa.binary()).dictionary_encode()
        place = np.empty(len(found.dictionary), np.int64)
        for k, word in enumerate(found.dictionary.to_pylist()):
            if word in (b"", b"\n"):
                place[k] = -2 if word == b"" else -1
                continue
            if (code := self.known.get(word)) is None:
                code = self.known[word] = len(self.names)
                self.names.append(word)
            place[k] = code
        codes = place[found.indices.to_numpy()]
        codes = codes[codes > -2]
        self.codes.append(codes)
        self.words += len(codes)

    def counted(self, bits: np.ndarray | None) -> Iterator[tuple[list[bytes], np.ndarray]]:
        """Keys and counts: of no, one and two words, or of three whose pairs the bit table holds."""
        if self.texts:
            self.encode()
        codes = np.concatenate([*self.codes, [-1]]) if self.codes else np.array([-1])
        names, lang = [escaped(w) for w in self.names], escaped(self.lang)
        size = max(1, len(names))
        inside = (codes[:-1] >= 0) & (codes[1:] >= 0)
        at = np.flatnonzero(inside)
        pairs, which, counts = np.unique(codes[at] * size + codes[at + 1], return_inverse=True, return_counts=True)
        left, right = pairs // size, pairs % size
        if bits is None:
            ones = np.bincount(codes[codes >= 0], minlength=len(names))
            yield [lang], np.array([ones.sum()])
            yield [lang + GAP + w for w in names], ones
            yield from _slices(lambda k: [lang + GAP + names[a] + GAP + names[b] for a, b in zip(left[k].tolist(), right[k].tolist())], counts)
            return
        marks = np.fromiter((word_mark(self.lang, w) for w in self.names), np.uint64, len(self.names))
        places = pair_places(marks[left], marks[right])
        common = (bits[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) == 1
        pair_at = np.full(len(codes), -1, np.int64)
        pair_at[at] = np.where(common[which], which, -1)
        start = np.flatnonzero((pair_at[:-1] >= 0) & (pair_at[1:] >= 0))
        threes, counts = np.unique(pair_at[start] * size + codes[start + 2], return_counts=True)
        head, last = threes // size, threes % size
        first, second = left[head], right[head]

        def keys(k: slice) -> list[bytes]:
            return [lang + GAP + names[a] + GAP + names[b] + GAP + names[c] for a, b, c in zip(first[k].tolist(), second[k].tolist(), last[k].tolist())]

        yield from _slices(keys, counts)


def _count(bits: np.ndarray | None):
    def rows(counter: _Counter) -> Iterator[pa.RecordBatch]:
        for keys, counts in counter.counted(bits):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(counts.astype(np.int64))], ["key", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[bytes, _Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("bytes")):
                lang = lang.as_py()
                if (counter := counters.get(lang)) is None:
                    counter = counters[lang] = _Counter(lang)
                counter.add(text.as_py())
                if counter.words >= BUFFER:
                    yield from rows(counters.pop(lang))
            if len(counters) > 50:  # a language a document: nothing is gained by waiting
                for counter in counters.values():
                    yield from rows(counter)
                counters = {}
        for counter in counters.values():
            yield from rows(counter)

    return run


def _frequent(docs: DataFrame, least: int, bits: np.ndarray | None) -> DataFrame:
    """Keys that count ``least`` or more; a language's own key counts at least as much as any phrase of it."""
    counted = docs.mapInArrow(_count(bits), "key binary, c long").groupBy("key").agg(F.sum("c").alias("c"))
    return counted.filter(F.col("c") >= least)


def _pair_table(ones_and_twos: DataFrame) -> np.ndarray:
    """Bits of the frequent pairs; 2 ** (TABLE_BITS - 6) numbers at most reach the driver."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [k for key in batch.column("key") if len(k := key.as_py().split(GAP)) == 3]
            first = np.array([word_mark(restored(k[0]), restored(k[1])) for k in keys], np.uint64)
            second = np.array([word_mark(restored(k[0]), restored(k[2])) for k in keys], np.uint64)
            at = pair_places(first, second)
            lanes, bits = (at >> np.uint64(6)).astype(np.int64), (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(lanes), pa.array(bits)], ["lane", "bits"])

    lanes = ones_and_twos.select("key").mapInArrow(places, "lane long, bits long").groupBy("lane").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
    got = lanes.toArrow()
    out[got.column("lane").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def reverse_key(key: bytes) -> bytes:
    lang, *words = key.split(GAP)
    return GAP.join([lang, *reversed(words)])


FIELDS = "key binary, c long, total long, left1 long, left2 long, longer long"


def _dealt(rows: DataFrame, backwards: bool, parts: int) -> DataFrame:
    """Records in prefix or suffix order, cut into ranges at two-word keys; each range with the shorter keys that reach into it."""
    turn = reverse_key if backwards else (lambda key: key)
    few = hashed_share(rows.select("key"), SAMPLE, "key").toArrow().column("key").to_pylist()
    sample = sorted(GAP.join(turn(k).split(GAP)[:3]) for k in few)
    bounds = sorted({sample[k * len(sample) // parts] for k in range(1, parts)}) if sample else []

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pick, part, order, home = [], [], [], []
            for k, key in enumerate(batch.column("key")):
                key = turn(key.as_py())
                first = last = bisect_right(bounds, key)
                if key.count(GAP) < 2:
                    last = bisect_left(bounds, key + GAP + b"\xff")
                for p in range(first, last + 1):
                    pick.append(k), part.append(p), order.append(key), home.append(p == first)
            taken = batch.take(pa.array(pick, pa.int64()))
            arrays = [*taken.columns, pa.array(part, pa.int32()), pa.array(order, pa.binary()), pa.array(home, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "part", "order", "home"])

    dealt = rows.mapInArrow(deal, FIELDS + ", part int, order binary, home boolean")
    return dealt.repartition(parts, "part").sortWithinPartitions("part", "order")


def _walk(backwards: bool):
    """One lockstep walk: what a phrase begins (ends) with was met just before it, what extends it comes just after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, pending = {}, None  # counts of the keys on the way to this one; the pair whose extensions come now

        def closed():
            row, longest = pending
            row[5] = max(row[5], longest)
            return row

        for batch in batches:
            out, columns = [], [batch.column(name).to_pylist() for name in ("key", "c", "total", "left1", "left2", "longer", "part", "order", "home")]
            for *row, part, order, home in zip(*columns):
                words = order.split(GAP)
                size = len(words) - 1
                if size < 3 and pending is not None:
                    out.append(closed())
                    pending = None
                open_[size] = (part, order, row[1])
                if size == 3 and pending is not None:
                    pending[1] = max(pending[1], row[1])
                if not home:
                    continue
                above = open_.get(1) if size > 1 else None
                beside = open_.get(2) if size > 2 else None
                if not backwards:
                    row[2] = open_[0][2]
                    row[3], row[4] = above and above[2], beside and beside[2]
                elif size > 1:
                    row.append(above[2])
                    row.append(beside and beside[2])
                row += [None] * (8 - len(row))
                if size == 2:
                    pending = [row, 0]
                else:
                    out.append(row)
            yield batch_of(out)
        if pending is not None:
            yield batch_of([closed()])

    def batch_of(out: list) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 8
        kinds = [pa.binary()] + [pa.int64()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], NAMES)

    return run


NAMES = ["key", "c", "total", "left1", "left2", "longer", "right1", "right2"]
WALKED = FIELDS + ", right1 long, right2 long"


def score(count: int, parts: list[tuple[int, int]]) -> tuple[int, int, int]:
    """Lowest score over the cuts of a phrase with its (left, right) counts; of equals the first cut.  Exact integers."""
    return min(((SCALE * count * count // (left * right), left, right) for left, right in parts), key=lambda x: x[0])


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for key, c, total, left1, left2, longer, right1, right2 in zip(*(batch.column(name).to_pylist() for name in NAMES)):
            lang, *words = (restored(w).decode() for w in key.split(GAP))
            if len(words) < 2 or (longer and 100 * longer >= COVERED * c):
                continue
            # After its first word a phrase of three goes on with the pair it ends with.
            cuts = [(left1, right1)] if len(words) == 2 else [(left1, right2), (left2, right1)]
            best, left, right = score(c, cuts)
            out.append((lang, " ".join(words), c, left, right, total, best))
        columns = list(zip(*out)) or [()] * 7
        kinds = [pa.string()] * 2 + [pa.int64()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds)], ["lang", "phrase", "a", "l", "r", "n", "score"])


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of two and three words of every language.

    A null text is empty, a null lang is ``und``; rows that repeat a document count again.  A language without
    candidates has no row.  ``least`` is at least 1.  Ties follow score, then count, then the phrase's bytes, so the ranks are
    the same in every run.  Other columns are ignored, so their names cannot clash.
    """
    read = docs.select(text_bytes(F.coalesce("lang", F.lit("und"))).alias("lang"), text_bytes().alias("bytes"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shorter = stored(_frequent(read, least, None))
    threes = stored(_frequent(read, least, _pair_table(shorter)))
    nothing = [F.lit(None).cast("long").alias(n) for n in ("total", "left1", "left2")]
    counts = shorter.unionByName(threes).select("key", "c", *nothing, F.lit(0).cast("long").alias("longer"))
    forth = stored(_dealt(counts, False, parts).mapInArrow(_walk(False), WALKED)).drop("right1", "right2")
    back = _dealt(forth, True, parts).mapInArrow(_walk(True), WALKED)
    scored = back.mapInArrow(_scored, "lang string, phrase string, a long, l long, r long, n long, score long")
    # A hot language is ranked in shares first, so one task gets at most ``parts * top`` of its phrases.
    best = [F.desc("score"), F.desc("a"), "phrase"]
    share = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    ahead = scored.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best)))
    place = Window.partitionBy("lang").orderBy(*best)
    ranked = ahead.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, doc_id, unnest(string_split_regex(
    translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
words as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as w from pieces),
grams as (
  select lang, unnest(flatten(list_transform([1, 2, 3], lambda k:
    list_transform(range(1, len(w) - k + 2), lambda i: list_slice(w, i, i + k - 1))))) as g
  from words where len(w) > 0),
f as (select lang, g, count(*) as c from grams group by all),
total as (select lang, sum(c) as n from f where len(g) = 1 group by lang),
often as (select lang, array_to_string(g, ' ') as p, g, c from f where c >= 10),
cand as (select * from often where len(g) > 1),
splits as (
  select lang, p, c as a, k, array_to_string(list_slice(g, 1, k), ' ') as head, array_to_string(list_slice(g, k + 1, len(g)), ' ') as tail
  from (select *, unnest(range(1, len(g))) as k from cand)),
cuts as (
  select s.lang, s.p, a, k, x.c as l, y.c as r, 1000000::hugeint * a * a // (x.c::hugeint * y.c) as score
  from splits s join often x on x.lang = s.lang and x.p = head join often y on y.lang = s.lang and y.p = tail),
best as (select * from cuts qualify row_number() over (partition by lang, p order by score, k) = 1),
longer as (
  select lang, unnest([g[1] || ' ' || g[2], g[2] || ' ' || g[3]]) as p, c from cand where len(g) = 3),
dropped as (select distinct s.lang, s.p from longer s join cand q on q.lang = s.lang and q.p = s.p where 100 * s.c >= 50 * q.c),
kept as (select b.*, b.p as phrase from best b anti join dropped d on d.lang = b.lang and d.p = b.p),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select r.lang, r.rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r.r::bigint as r, t.n::bigint as n, score::bigint as score
from ranked r join total t on t.lang = r.lang where rank <= 2000
"""


@query(SQL)
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents", "lang", "text"))
