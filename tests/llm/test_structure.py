"""Nearest neighbours, conversation repair and collocations: brute force, odd rows, ties, empty tables."""

import hashlib
import itertools
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quirework.llm import neighbours, phrases, repair
from quirework.llm.common import QUERIES

FOLDER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


# nearest neighbours

def exact(rows, every, k):
    out = {}
    usable = [(n, i, np.array(v, float)) for n, (i, v) in enumerate(rows) if v is not None and None not in v and np.isfinite(v).all() and any(v)]
    widths = Counter(len(v) for _, _, v in usable)
    width = max(widths, key=lambda w: (widths[w], w))
    usable = [x for x in usable if len(x[2]) == width]
    for n, i, v in usable:
        if i is not None and i % every == 0:
            scored = sorted(((-(w * v).sum(), j is None, j or 0) for m, j, w in usable if m != n))[:k]
            out.setdefault(i, []).append([(None if null else j, -s) for s, null, j in scored])
    return out


def found(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 24))
    rows = [(i, (centres[rng.integers(12)] * rng.uniform(0.5, 2) + 0.7 * rng.standard_normal(24)).tolist()) for i in range(3000)]
    got = found(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, vector array<double>"), k=10, cell=300))
    want = exact(rows, 20, 10)
    assert set(got) == set(want)
    x = np.array([v for _, v in rows])
    hit = 0
    for i, (best,) in want.items():
        ranked = sorted(got[i])
        assert [r for r, _, _ in ranked] == list(range(1, 11)) and ranked == sorted(ranked, key=lambda r: (-r[2], r[1]))
        assert all(s == (x[j] * x[i]).sum() for _, j, s in ranked)
        hit += len({j for j, _ in best} & {j for _, j, _ in ranked})
    assert hit >= 0.95 * 10 * len(want)


def test_neighbours_odd_rows(spark):
    """Copies of one vector in a third of all rows, one long vector, nulls, another width, repeated and missing ids."""
    rows = [(i, [1.0, 0.5, 0.0, 0.25]) for i in range(400)]
    rows += [(1000 + i, [float(i % 7 - 3), float(i % 5 - 2), 1.0, float(i % 3)]) for i in range(500)]
    rows += [(2000, [1e6, 0.0, 0.0, 0.0]), (2001, None), (2020, [0.0] * 4), (2040, [1.0, None, 0.0, 0.0]), (2060, [float("nan"), 1.0, 0.0, 0.0])]
    rows += [(2080, [1.0, 2.0]), (2100, []), (None, [1.0, 1.0, 1.0, 1.0]), (None, [2.0, 2.0, 2.0, 2.0]), (2120, [0.5, 0.5, 0.5, 0.5]), (2120, [0.5, 0.5, 0.5, 0.5])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, vector array<double>, key string").repartition(5)
    got = found(neighbours.nearest(frame, k=5, cell=64, sure=1 - 1e-9))
    want = exact(rows, 20, 5)
    assert set(got) == set(want)
    for i, lists in want.items():
        flat = sorted((rank + 1, j is None, j or 0, s) for best in lists for rank, (j, s) in enumerate(best))
        assert sorted((r, j is None, j or 0, s) for r, j, s in got[i]) == flat, i


def test_neighbours_few_and_none(spark):
    schema = "vec_id long, vector array<float>"
    assert neighbours.nearest(spark.createDataFrame([], schema)).count() == 0
    assert neighbours.nearest(spark.createDataFrame([(20, None)], schema)).count() == 0
    got = found(neighbours.nearest(spark.createDataFrame([(20, [1.0, 0.0]), (3, [0.5, 2.0]), (4, [0.5, 1.0])], schema)))
    assert got == {20: [(1, 3, 0.5), (2, 4, 0.5)]}


def test_stopping_law():
    x = np.random.default_rng(1).chisquare(8, 200_000)
    for p in (0.5, 0.9, 0.97):
        assert abs((x <= neighbours.chi_square_point(p, 8)).mean() - p) < 0.005


@needs_tables
def test_neighbours_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    got, want = found(QUERIES["op11_neighbours"](spark, FOLDER)), exact(rows, 20, 20)
    hits = [len({j for j, _ in best} & {j for _, j, _ in got[i]}) for i, (best,) in want.items()]
    assert set(got) == set(want) and sum(hits) >= 0.9 * 20 * len(hits)


# conversation repair

def cheapest(rows):
    """Lightest (cost, audit) by trying every role sequence: rows are (initial, fault)."""
    best = {0: (0, "")}  # by state, letting any number of insertions up to two stand anywhere

    def put(table, state, weight):
        if state not in table or weight < table[state]:
            table[state] = weight

    role_after = {0: "u", 1: "u", 3: "u", 2: "a"}
    go = lambda q, c: {"s": 1 if q == 0 else None, "u": 2 if q != 2 else None, "a": 3 if q == 2 else None}.get(c)

    def with_insertions(table):
        out = dict(table)
        for q, (cost, audit) in table.items():
            for n in (1, 2, 3):
                q, cost, audit = go(q, role_after[q]), cost + 5, audit + "I"
                put(out, q, (cost, audit))
        return out

    for initial, fault in rows:
        after = {}
        for q, (cost, audit) in with_insertions(best).items():
            put(after, q, (cost + 2, audit + "D"))
            if fault in (1, 2):
                continue
            more = 5 if fault == 3 else 0
            if go(q, initial) is not None:
                put(after, go(q, initial), (cost + more, audit + "K"))
            put(after, go(q, role_after[q]), (cost + 1 + more, audit + "R"))
        best = after
    return min(w for q, w in with_insertions(best).items() if q in (0, 3))


def test_agenda_against_every_sequence():
    for n in range(5):
        for initials in itertools.product("sua", repeat=n):
            for faults in itertools.product((0, 1, 3), repeat=n):
                rows = list(zip(initials, faults))
                ((got),) = repair.derive({repair.START: (0, "")}, rows).values()
                assert got == cheapest(rows), rows


def brute_repair(rows):
    """By the contract, in plain Python; rows are (conv_id, turn, role, text)."""
    convs = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[conv] += [] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, marked = set(), []
        for _, role, text in turns:
            core = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 1 if not core else 2 if (role, text) in seen else 3 if core[-1] not in ".!?" else 0
            seen.add((role, text))
            marked.append((role[:1], fault))
        cost, audit = cheapest(marked)
        at, q, said = iter(turns), "", []
        for letter in audit:
            free = "assistant" if q == "u" else "user"
            _, role, text = (None, free, "") if letter == "I" else next(at)
            if letter != "D":
                role = role if letter == "K" else free
                said.append(f"{role}:{text}")
                q = role[0]
        known = [t for t, _, _ in turns if t is not None]
        count = Counter(f for _, f in marked)
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out.append((conv, gaps, count[1], count[2], count[3], illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def repaired(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in repair.repair_damaged(df).collect()), key=repr)


def test_repair_odd_rows(spark):
    rng = np.random.default_rng(8)
    texts = ["Yes.", "no", "", " \n", None, "What?", "Ok!  \n", "über. 漢", "Long. " * 3000, "a\x0bb"]
    roles = ["user", "assistant", "system", "tool", "", None, "sudo"]
    rows = [
        (int(c), None if rng.random() < 0.05 else int(t), roles[int(min(rng.integers(9), 6)) if rng.random() < 0.3 else t % 2], texts[rng.integers(10)])
        for c in range(60) for t in range(rng.integers(1, 9))
    ]
    rows += [(None, t, "user", "Hi.") for t in range(5)] + [(100, t % 7, "user", "Hi.") for t in range(40)] + [(101, None, "user", None)]
    for t in range(40):  # alone in its conversation, and dropped there
        if zlib.crc32(f"{200 + t}:0".encode()) % 20 == 0:
            rows.append((200 + t, 0, "user", "gone."))
    frame = spark.createDataFrame([(*r, 1, "d") for r in rows], "conv_id long, turn long, role string, text string, n int, digest string").repartition(4)
    assert repaired(frame) == brute_repair(rows)


def test_repair_in_chunks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [("suat"[rng.integers(4)] if rng.random() < 0.4 else "ua"[n % 2], int(rng.choice([0, 0, 0, 1, 2, 3]))) for n in range(400)]
    for chunk in (1, 2, 7, 512):
        monkeypatch.setattr(repair, "CHUNK", chunk)
        whole = repair._Derivation()
        for n, row in enumerate(rows):
            whole.add(n, *row)
        assert whole.result()[-2:] == cheapest(rows)
    long = spark.createDataFrame([(7, t, "user" if t % 2 == 0 else "assistant", f"Line {t % 900}.") for t in range(3000)], "conv_id long, turn long, role string, text string")
    assert repaired(long) == brute_repair([tuple(r) for r in long.collect()])


def test_repair_empty(spark):
    assert repair.repair_damaged(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# collocations

def brute_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    out = defaultdict(list)
    for key, a in f.items():
        lang, *w = key
        if len(w) < 2 or a < least:
            continue
        longer = [c for g, c in f.items() if len(g) == 4 and len(w) == 2 and g[0] == lang and c >= least and tuple(w) in (g[1:3], g[2:4])]
        if any(100 * c >= 50 * a for c in longer):
            continue
        cuts = [(1_000_000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        best, k = min(cuts)
        out[lang].append((-best, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, rows in out.items() for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])
    )


def test_phrases_brute(spark):
    rng = np.random.default_rng(4)
    vocabulary = ["the", "The", "of", "über", "漢字", "a\x01", "a", "a\x00b", "new", "york", "city", "\x7f", "x"]
    def text():
        words = [vocabulary[min(int(rng.exponential(3)), 12)] for _ in range(rng.integers(0, 60))]
        return "".join(w + [" ", "  ", "\t", ", ", ".\n", " "][rng.integers(6)] for w in words)
    rows = [(["en", "de", None, "und", "en", "e\x00n"][rng.integers(6)], text()) for _ in range(150)]
    rows += [("en", None), (None, None), ("en", ""), ("en", " ".join(["new york city"] * 4000)), ("rare", "one two three"), ("", "a b " * 12)]
    frame = spark.createDataFrame([(*r, "k", 3) for r in rows], "lang string, text string, key string, c long").repartition(4)
    for least, top in ((1, 50), (3, 2000), (10, 7)):
        got = sorted(tuple(r) for r in phrases.collocations(frame, least, top).collect())
        assert got == brute_phrases(rows, least, top), (least, top)


def test_phrases_in_small_buffers(spark, monkeypatch):
    rows = [("en", "a b c. a b d " * (5 + i % 3)) for i in range(30)]
    frame = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    bits = np.full(1 << (phrases.TABLE_BITS - 6), ~np.uint64(0))
    for buffer in (1, 40, 10**6):
        monkeypatch.setattr(phrases, "BUFFER", buffer)
        monkeypatch.setattr(phrases, "CHUNK", 16)
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays([pa.array([x.encode() for _, x in rows]) if c else pa.array([x.encode() for x, _ in rows]) for c in (0, 1)], ["lang", "bytes"])
        counts = Counter()
        for table in (None, bits):
            for out in phrases._count(table)(iter([batch])):
                for key, c in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
                    counts[key] += c
        assert counts[b"en\0\0a\0\0b\0\0c"] == sum(5 + i % 3 for i in range(30)) and counts[b"en"] == 6 * counts[b"en\0\0a\0\0b\0\0c"]
    assert frame.count() == 30


def test_phrases_exact_beyond_64_bits():
    a = 3 * 10**12
    assert phrases.score(a, [(a + 1, a + 2), (a, a + 3)]) == (1_000_000 * a * a // (a * (a + 3)), a, a + 3) or phrases.score(a, [(a + 1, a + 2), (a, a + 3)])[0] == 999_999


def test_phrases_empty(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
