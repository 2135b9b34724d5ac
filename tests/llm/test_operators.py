"""The dealt operators against brute force, and their defined results for odd input."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row

from quirework.llm import chat, decontaminate, exact, extraction, mixing, quality, sharding, simhash, substrings, toxicity
from quirework.llm.common import QUERIES
from quirework.llm.components import components

FOLDER, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash long, slot string, bytes string, __row int"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
TEXTS = [
    (1, "a b c d e f g h i j k l m n o p"), (2, "x a b c d e f g h i j k l m y"), (3, None), (4, ""), (5, " \t\n "),
    (6, "a b c d e f g h i j k l m n o p"), (7, "A  b\tc d e f g h i j k l m n o p"), (8, "kurz"), (9, LONG), (10, LONG + " end"),
    (None, "a b c d e f g h i j k l m"), (11, "ü ö ä ß 漢 字 é"), (11, "ü ö ä ß 漢 字 é"), (12, "a b c d e f g h i j k l m n o p  "),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, None if i in (3, 8) else f"s{(i or 0) % 3}", None, 7, "s", "b", 1) for i, t in TEXTS]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def by_id(df, *columns):
    return sorted((tuple(r[c] for c in ("doc_id", *columns)) for r in df.collect()), key=repr)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_substrings_brute(docs):
    rows = [((1 << 63) if i is None else i, words(t)) for i, t in TEXTS]
    first = {}
    for i, w in rows:
        for k in range(len(w) - 12):
            first[tuple(w[k : k + 13])] = min(i, first.get(tuple(w[k : k + 13]), i))
    want = []
    for (i, w), (doc_id, _) in zip(rows, TEXTS):
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        want.append((doc_id, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    for options in ({}, {"block_bytes": 1, "range_windows": 1}, {"block_bytes": 100_000, "range_windows": 9_000}):
        found = substrings.dedup_substrings(docs, **options)
        assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], bytes(r["kept"]).decode()) for r in found.collect()), key=repr) == sorted(want, key=repr)


def test_substrings_spans(docs):
    spans = {r["doc_id"]: r["spans"] for r in substrings.dedup_substrings(docs).collect()}
    assert spans[2] == [[1, 14]] and spans[6] == [[0, 16]] and spans[1] == [] and spans[10] == [[0, 60_000]]


def test_substrings_crowded_ids(spark):
    """Nearly all ids in one stretch, one id and no id on very many rows: blocks are cut finer and sliced, results stay."""
    rng = np.random.default_rng(5)
    passages = [" ".join(f"p{k}w{j}" for j in range(15)) for k in range(6)]
    ids = [*range(40), *[77] * 12, *[None] * 12, 10**15, 3 * 10**15]
    rows = [(i, f"a{n} {passages[rng.integers(6)]} b{n} {passages[rng.integers(6)]}") for n, i in enumerate(ids)]
    top = (1 << 63) - 1
    first = {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(first.get(key, top), top if i is None else i)
    want = []
    for i, t in rows:
        w = t.split()
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < (top if i is None else i) for j in range(13)}
        want.append((i, len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for size in (20, 200, 4_000_000):
        found = [(r["doc_id"], r["n_removed"], bytes(r["kept"]).decode()) for r in substrings.dedup_substrings(df, block_bytes=size).collect()]
        assert sorted(found, key=repr) == sorted(want, key=repr)


def test_window_hashes_in_steps(monkeypatch):
    text = " ".join(f"v{i % 31}" for i in range(500)).encode()
    whole = substrings.window_hashes(text, *substrings.bounds(text))
    monkeypatch.setattr(substrings, "STEP", 7)
    parts = substrings.window_hashes(text, *substrings.bounds(text))
    w = text.split()
    assert all((a == b).all() for a, b in zip(whole, parts))
    assert len(set(whole[0].tolist())) == len({tuple(w[i : i + 13]) for i in range(len(w) - 12)})


def test_exact_brute(docs):
    rows = [(i, t or "", re.sub(r"[\x20\x09-\x0D]", "", t or "")) for i, t in TEXTS]
    groups = defaultdict(list)
    for i, t, plain in rows:
        groups[plain].append((-len(t), (1 << 63) if i is None else i))
    want = []
    for i, t, plain in rows:
        best = min(groups[plain])
        keep = None if best[1] == 1 << 63 else best[1]
        kept = i == keep and -len(t) == best[0]
        want.append((i, keep, len(groups[plain]), kept, hashlib.sha256(plain.encode()).hexdigest()))
    for size in (1, 100, 4_000_000):
        found = exact.dedup_exact(docs, bucket_bytes=size)
        assert by_id(found, "keep_id", "group_size", "kept", "digest") == sorted(want, key=repr)


def test_exact_chain_tells_collisions_apart():
    chains = exact._Chains()
    for text, keep in ((b"one", 5), (b"two", 6), (b"one", 3), (b"two", None)):
        chains.add(77, text.decode(), text, 1, 3, keep)
    assert [(x[0], x[2], x[4]) for x in chains.chains[77]] == [("one", 2, 3), ("two", 2, 6)]


def test_directory_doubles_until_buckets_fit():
    depth, slots = exact.directory({0: 10, 1: 1, 2: 1, 3: 1, 12: 3}, 4, 4)
    held = defaultdict(int)
    for slot, bucket, local in slots:
        assert bucket >> (depth - local) == slot >> (depth - local)
    weights = {0: 10, 1: 1, 2: 1, 3: 1, 12: 3}
    for cell, weight in weights.items():
        held[slots[cell >> (4 - depth)][1]] += weight
    assert depth == 4 and max(w for b, w in held.items() if b) <= 4 and len(slots) == 16


def brute_prints(texts):
    found = []
    for text in texts:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        found.append(sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)))
    return found


def brute_components(ids, prints, bits=3):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    low = {}
    for i, p in zip(ids, prints):
        if i is not None:
            low[find(p)] = min(i, low.get(find(p), i))
    return [low.get(find(p)) for p in prints]


def test_simhash_odd_rows(docs):
    ids, texts = [i for i, _ in TEXTS], [t if t is None or len(t) < 1000 else t for _, t in TEXTS]
    short = [(i, t) for i, t in zip(ids, texts) if not t or len(t) < 1000]
    prints = brute_prints([t for _, t in short])
    want = [(i, p - (1 << 64) if p >> 63 else p, c) for (i, _), p, c in zip(short, prints, brute_components([i for i, _ in short], prints))]
    few = docs.filter("text is null or length(text) < 1000")
    assert by_id(simhash.near_duplicates(few), "fp", "component_id") == sorted(want, key=repr)


@needs_tables
def test_simhash_brute(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    prints = brute_prints([r["text"] for r in rows])
    parts = brute_components([r["doc_id"] for r in rows], prints)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op9_simhash"](spark, FOLDER).collect()}
    assert found == {r["doc_id"]: (f"{p:016x}", c) for r, p, c in zip(rows, prints, parts)}


@pytest.mark.parametrize("pairwise", [1, 2048])
def test_postings_keep_every_link(pairwise):
    """Both ways to find the links of a posting join what all pairs join."""
    draw = np.random.default_rng(3)
    number = 11
    free = sorted(set(range(8)) - set(simhash.CHOICES[number]))
    base = int(draw.integers(0, 1 << 62))
    prints = set()
    for _ in range(60):
        value = base
        for _ in range(int(draw.integers(0, 9))):
            value ^= 1 << (8 * int(draw.choice(free)) + int(draw.integers(0, 8)))
        prints.add(value)
    prints = sorted(prints)
    tree = simhash.links_of(np.array(prints, np.uint64), number << 32, pairwise)
    assert len(tree) < len(prints) and all((prints[i] ^ prints[j]).bit_count() <= 3 for i, j in tree)
    root = list(range(len(prints)))
    for i, j in tree:
        a, b = root[i], root[j]
        root = [a if x == b else x for x in root]
    want = brute_components(list(range(len(prints))), prints)
    assert len(set(zip(root, want))) == len(set(root)) == len(set(want))


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(300, 400)] + [(399, 7), (5, 5), (2, 1)]
    found = {r["u"]: r["v"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {i: 100 for i in range(101, 141)} | {i: 7 for i in range(300, 400)} | {2: 1}


def test_decontaminate_brute(spark, docs):
    items = [(1, "a b c d e f g h i j"), (2, "Kurz!"), (2, "漢"), (3, None), (4, "zz"), (30, "c D e-f g h i j k l m n"), (None, "ä ß")]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def fold(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    want = []
    for i, t in TEXTS:
        w, hit, ids = fold(t), set(), set()
        for item, text in items:
            p = fold(text)
            m = min(10, len(p))
            for s in range(len(p) - m + 1 if m else 0):
                for k in range(len(w) - m + 1):
                    if w[k : k + m] == p[s : s + m]:
                        hit |= set(range(k, k + m))
                        ids.add(item)
        want.append((i, len(w), len(hit), sorted(ids, key=lambda x: (x is None, x or 0))))
    for size in (decontaminate.PASS_BYTES, 3):
        found = decontaminate.decontaminate(docs, bench, pass_bytes=size)
        assert by_id(found, "n_words", "n_hit", "item_ids") == sorted(want, key=repr)
    assert decontaminate.decontaminate(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


def best_capacity(sizes, shards):
    sums = np.r_[0, np.cumsum(sizes)]
    best = sums.astype(float).copy()
    for _ in range(shards - 1):
        best = np.array([min(max(best[j], sums[i] - sums[j]) for j in range(i + 1)) for i in range(len(sums))])
    return int(best[-1])


@pytest.mark.parametrize("shards, digits", [(4, 1), (16, 4), (3, 2)])
def test_sharding_is_minimax(spark, monkeypatch, shards, digits):
    monkeypatch.setattr(sharding, "FIRST_DIGITS", digits)
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    draw = np.random.default_rng(shards)
    texts = [None, "", "ä" * 50] + [f"t{i % 90}" * int(draw.integers(1, 60)) for i in range(150)] + ["copy of all"] * 120
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, shard int").repartition(3)
    rows = sharding.shard(df, shards).collect()
    assert len(rows) == len(texts)
    groups, where, load, slots = Counter(), {}, Counter(), defaultdict(list)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert (r["size"], r["crc"]) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
        assert where.setdefault(r["digest"], r["shard"]) == r["shard"]
        groups[r["digest"]] += r["size"]
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert [where[d] for d in sorted(where)] == sorted(where[d] for d in sorted(where))
    assert max(load.values()) == best_capacity([groups[d] for d in sorted(groups)], shards)


@pytest.mark.parametrize("share, at", [(2, 0.5), (3, 0.1), (12, 0.7), (15, 0.4)])
def test_sharding_sums_stay_bounded(spark, monkeypatch, share, at):
    """A group with 1 / share of all bytes does not bring a sum per group to the driver."""
    monkeypatch.setattr(sharding, "FIRST_DIGITS", 2)
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    seen, kind = [], sharding.Stretch
    monkeypatch.setattr(sharding, "Stretch", lambda *a: seen.append(a) or kind(*a))
    draw = np.random.default_rng(share)
    digests = sorted(hashlib.sha256(str(i).encode()).hexdigest() for i in range(20_000))
    sizes = [int(n) for n in draw.integers(50, 150, len(digests))]
    hot = int(len(digests) * at)
    sizes[hot] = (sum(sizes) - sizes[hot]) // (share - 1)
    groups = spark.createDataFrame(list(zip(digests, sizes)), "digest string, size long").repartition(3)
    found = sharding.cuts(groups, 16)
    load = Counter()
    for d, n in zip(digests, sizes):
        load[sum(d >= cut for cut in found)] += n
    assert max(load.values()) == sharding.smallest_capacity(sizes, 16)
    assert len(seen) < len(digests) // 4
    # With a small bound on what is opened at a time the cuts are the same.
    monkeypatch.setattr(sharding, "OPENED", 3)
    assert sharding.cuts(groups, 16) == found


def test_mixing_law(spark):
    draw = np.random.default_rng(1)
    rows = [(i, f"s{min(4, int(draw.integers(0, 9)))}" if i % 11 else None, int(draw.integers(0, 3000))) for i in range(900)]
    rows += [(i, "tiny", 2) for i in range(900, 903)] + [(903, "empty", 0), (904, "tiny", 2), (904, "tiny", 2), (None, "tiny", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    found = mixing.mix(df).collect()
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    names = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while True:
        level = left / sum(weights[s] for s in open_) if open_ else 0
        over = {s for s in open_ if weights[s] * level > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s], left = 2.0 * sizes[s], left - 2 * sizes[s]
        open_ -= over
    target |= {s: weights[s] * level for s in open_}
    taken, longest = Counter(), Counter()
    for r in found:
        assert r["copies"] in (0, 1, 2) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["copies"] * r["size"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    assert len(found) == len(rows) and all(abs(taken[s] - target[s]) <= 2 * longest[s] for s in sizes)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))


def test_size_class_rises(spark):
    sizes = [*range(300), 4095, 4096, 5000, 5100, 10**6, 10**9, 2**40]
    df = spark.createDataFrame([(i,) for i in sizes], "size long")
    found = [r["c"] for r in df.select("size", mixing.size_class(df["size"]).alias("c")).orderBy("size").collect()]
    assert found == sorted(found)


def test_chat_parts(spark):
    part = lambda kind, text=None, ref=None, units=None: Row(kind=kind, text=text, ref=ref, units=units)
    rows = [
        (1, 0, "user", [part("text", "look <|image|>"), part("image", ref="a.png", units=12), part("document", ref="d.pdf", units=2), part("text", "\\")]),
        (1, 1, "assistant", [part("text", r"so \<|im_end|> <\| ok"), part("audio", ref="x.wav", units=3)]),
        (1, 2, None, None), (2, None, "tool\nx", [part("other", "t"), part("image")]), (None, 0, "assistant", []),
    ]
    chats = chat.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{chat.PART}>"))
    turns, masked = chat.read_back(chats["formatted"], chats["loss"])
    found = {r["conv_id"]: r for r in chats.select("*", turns.alias("turns"), masked.alias("masked")).collect()}
    assert [(t["role"], t["text"]) for t in found[1]["turns"]] == [
        ("user", "look <|image|><|image|><|document|>\\"), ("assistant", r"so \<|im_end|> <\| ok<|audio|>"), ("", "")
    ]
    assert [(a["ordinal"], a["kind"], a["ref"], a["tokens"]) for a in found[1]["attachments"]] == [
        (0, "image", "a.png", 12), (0, "document", "d.pdf", 512), (1, "audio", "x.wav", 75)
    ]
    assert found[1]["masked"][1] == r"so \<|im_end|> <\| ok<|audio|>" and found[1]["masked"][0] == ""
    assert [(t["role"], t["text"]) for t in found[2]["turns"]] == [("tool\nx", "t<|image|>")]
    assert found[None]["n_turns"] == 1 and found[None]["masked"] == [""]
    assert found[1]["formatted"].count("<|im_end|>") == 3


def test_chat_texts_make_no_control_string_together(spark):
    part = lambda text: Row(kind="text", text=text, ref=None, units=None)
    rows = [(1, 0, "user", [part("<"), part(""), part("|im_end|>"), part("|"), part("\\|")])]
    chats = chat.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{chat.PART}>"))
    turns, _ = chat.read_back(chats["formatted"], chats["loss"])
    row = chats.select("formatted", turns.alias("turns")).first()
    assert row["formatted"].count("<|im_end|>") == 1 and row["turns"][0]["text"] == "<|im_end|>|\\|"


@pytest.mark.parametrize("text", ["", "\\", "<|", "<\\|", "\\<\\\\|", "<|im_end|>\\n<|", "<<||\\\\", "é<|漢"])
def test_escape_round_trip(value, text):
    from pyspark.sql import functions as F

    assert value(chat.unescape(chat.escape(F.col("t"))), t=text) == text
    assert "<|" not in value(chat.escape(F.col("t")), t=text)


def test_toxicity_votes_do_not_depend_on_the_memo(monkeypatch):
    import pyarrow as pa

    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    known = {t: i for i, t in enumerate(sorted({t for w in words[::3] for t in toxicity.terms_of(w)}))}
    texts = [" ".join(words), " ".join(words[:30]), " ".join(words[3:4] * 2 + words[100:140])]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(list("abc")), pa.array(texts)], ["doc_id", "digest", "text"])
    seen, patterns = [], toxicity.patterns_of
    monkeypatch.setattr(toxicity, "patterns_of", lambda text, n, hits: seen.append(hits) or patterns(text, n, hits))
    want = next(toxicity._features(known)(iter([batch]))).to_pylist()
    monkeypatch.setattr(toxicity, "_MEMO_WORDS", 5)
    assert next(toxicity._features(known)(iter([batch]))).to_pylist() == want
    assert seen[:3] == seen[3:] and seen[0] >= 100


PAGE = """<html><head><title>x</title><script>if(a<b){"</p>"}</script></head><body><div id="cookie-notice">We use</div>
<header><h1>Site</h1></header><div class="wrap"><div class=sidebar><p>side</p></div><div class="post-12 content"><h1>T &amp; X</h1>
<p>Hello <a href="/x>y">wor</a>ld &lt;b&gt;  more<p>para&nbsp;2<ul><li>one<li>two</ul><form><input></form>
<div class="comments"><p>nice comment long long long long</p></div><!-- c --></div></div><footer>f</footer>"""


def test_extraction_blocks_and_votes(spark):
    poor = '<body><div class="wrap"><div class="content post-7"><p>hi</p></div><div class="teaser"><p>much longer teaser text here</p></div></div>'
    rows = [(1, "http://h.org/a", PAGE), (2, "http://h.org/b", PAGE), (3, "http://H.org/c", poor), (4, None, None), (5, "", ""), (6, "x", "plain <b>text"), (6, "x", "plain <b>text")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, path string")
    found = sorted((r["page_id"], r["text"]) for r in extraction.extract_pages(df).collect())
    article = "T & X\nHello world <b> more\npara 2\none\ntwo"
    assert found == [(1, article), (2, article), (3, "hi"), (4, ""), (5, ""), (6, "plain text"), (6, "plain text")]
    assert extraction.Page(poor).text(None) != "hi"  # alone, the page would have chosen otherwise


ARTICLE = "<h1>Title</h1><p>The first paragraph has prose.</p><p>The second has some more.</p>"
ASIDE = '<div class="sidebar"><p>side</p></div><div id="comments"><p>nice</p></div><form><p>search</p></form>'


@pytest.mark.parametrize(
    "page",
    [
        f'<body><div class="content-sidebar-wrap">{ARTICLE}</div>{ASIDE}', f'<body><div class="site has-sidebar">{ARTICLE}{ASIDE}</div>',
        f'<body><div id="page" class="no-comments">{ARTICLE}{ASIDE}</div>', f'<body><form id="aspnetForm"><div>{ARTICLE}{ASIDE}</div></form>',
        f'<body><form><main>{ARTICLE}</main><div class="comments"><p>{"long talk " * 50}</p></div></form>',
        f'<body><article>{ARTICLE}</article><div class="comments"><article><p>{"long talk " * 50}</p></article></div>',
        f'<body><main><article>{ARTICLE}</article><div id="comments"><p>{"long talk " * 50}</p></div></main>',
        f'<body><form role="form"><div><h1>Title</h1><p>The first paragraph has prose.</p>The second <span class="ad">x</span>has some more.</div>{ASIDE}</form>',
    ],
)
def test_extraction_keeps_wrapped_articles(page):
    assert extraction.Page(page).text(None) == "Title\nThe first paragraph has prose.\nThe second has some more."


def test_extraction_of_deep_and_broken_pages():
    """Time and memory follow the length of a page: deep nesting, stray end tags, elements that never end."""
    import time
    import tracemalloc

    pages = {
        "<div>" * 36_000 + "<p>text": "text", "<span>" * 20_000 + "</b>" * 20_000 + "<p>text": "text",
        "<p><td>" + "<span>" * 20_000 + "<p></p>" * 3_000 + "text": "text", "<ul>" + "<li><span>" * 10_000 + "text": "text",
    }
    for page, want in pages.items():
        tracemalloc.start()
        began = time.perf_counter()
        found = extraction.Page(page)
        vote = found.vote()
        assert found.text(vote and vote[0]) == want and time.perf_counter() - began < 10
        assert tracemalloc.get_traced_memory()[1] < 100e6
        tracemalloc.stop()


SITES = {
    "blog": ('<div id="page" class="hfeed site"><header class="site-header"><p>Site</p></header><div class="site-content"><div class="entry-content">{}</div><div class="comments-area"><p>I like it very much indeed</p></div></div></div>', "<p>Prose of the entry goes on.</p><p>And on.</p>", "Prose of the entry goes on.\nAnd on."),
    "docs": ('<div class="sidebar-left"><ul><li><a href="/a">A</a></li></ul></div><main><div class="document">{}</div></main>', '<h1>Call</h1><div class="alert alert-info"><p>Mind the gap.</p></div><p>Then call it.</p>', "Call\nMind the gap.\nThen call it."),
    "paper": ("<article>{}</article>", '<h1>On sums</h1><div class="related-work"><p>Others summed.</p></div><div class="search-results-table">Rows</div>', "On sums\nOthers summed.\nRows"),
    "news": ('<div class="content-sidebar-wrap"><div class="story">{}</div><div class="sidebar"><p>More</p></div></div>', '<h1>News</h1><p>It happened today.</p><div class="ad-box"><p>Buy</p></div><p>Nobody was hurt.</p>', "News\nIt happened today.\nNobody was hurt."),
    "shop": ('<form id="f"><div class="main-text">{}</div><div class="newsletter signup"><p>Join</p></div></form>', "<h1>Lamp</h1><p>It gives light to all.</p>", "Lamp\nIt gives light to all."),
    "forum": ('<div class="breadcrumb"><a href="/">x</a></div><article class="post">{}</article><div id="replies"><p>yes</p></div>', "<p>Who knows &lt;b&gt;?</p><ul><li>me</li></ul>", "Who knows <b>?\nme"),
    "recipe": ('<div class="wrap"><section class="recipe-body">{}</section><div class="share-buttons">tweet</div></div>', "<h2>Soup</h2><p>Boil water for long.</p><p>Salt.</p>", "Soup\nBoil water for long.\nSalt."),
    "old": ("<table><tr><td class=nav><a href=/>home</a></td><td>{}</td></tr></table>", "<p>Old page with prose<p>in two parts", "Old page with prose\nin two parts"),
}


@pytest.mark.parametrize("site", SITES)
def test_extraction_of_site_forms(site):
    frame, article, want = SITES[site]
    assert extraction.Page(f"<html><body>{frame.format(article)}<footer>f</footer></body></html>").text(None) == want


def test_quality_cut_follows_the_corpus(spark):
    """The level comes from the sample, the cut from all documents: with another mix, another cut."""
    draw = np.random.default_rng(6)
    for values in (draw.normal(0, 1, 5000), np.r_[draw.normal(-3, 1, 4000), draw.normal(5, 1, 500), np.zeros(500)], np.ones(50), draw.exponential(1e6, 999)):
        frame = spark.createDataFrame([(float(v),) for v in values], "raw double").repartition(4)
        for level in (0.0, 0.1, 0.5, 0.83, 1.0):
            cut = quality.quantile_cut(frame, "raw", level)
            wanted = int(round(level * len(values)))
            below, upto = int((values < cut).sum()), int((values <= cut + 1e-6).sum())  # a tie may straddle the level
            assert abs(below - wanted) <= 1 or below <= wanted <= upto, (level, below, wanted, upto)


def test_simhash_rows_without_id_link(spark):
    """A row without doc_id joins the documents on both sides of it, and near copies without any doc_id stay linked."""
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(None, base), (None, base + " x"), (None, "another text altogether"), (5, base + " y"), (None, "alone and far away from it")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(frame).collect()
    prints = {r["digest"]: (r["fp"] & (2**64 - 1), r["root"], r["component_id"]) for r in found}
    for a in prints.values():
        for b in prints.values():
            if (a[0] ^ b[0]).bit_count() <= 3:
                assert a[1:] == b[1:]
    assert any(c == 5 for _, _, c in prints.values()) and any(c is None for _, _, c in prints.values())


def test_extraction_keeps_anchors():
    page = """<body><article><h2 id="search-algorithms">Search</h2><p>one</p><section id="related-work"><p id="share-prices">two</p></section>
    <p class="lead-skip-over">three</p><div class="share">tweet</div><div id="cookie-notice">We use</div></article>"""
    assert extraction.Page(page).text(None) == "Search\none\ntwo\nthree"


@needs_tables
def test_extraction_brute(spark):
    from html import unescape

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in QUERIES["op7_extraction"](spark, FOLDER).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


@needs_tables
@pytest.mark.parametrize("name, mark, least", [("op1_toxicity", "toxic", 0.93), ("op4_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, mark, least):
    truth = {r["doc_id"]: r[mark] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = QUERIES[name](spark, LARGER).collect()
    folds, fold = (3, 1) if mark == "toxic" else (4, 2)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == fold) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    known = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in known) / len(known) >= least
    clean = [r for r in known if truth[r["doc_id"]] == (0 if mark == "toxic" else 1)]
    assert sum(r["predicted"] != (0 if mark == "toxic" else 1) for r in clean) <= 0.02 * len(clean)


def test_filters_on_odd_rows(spark, docs):
    marks = [(i, i % 2, i % 2) for i in range(1, 12)] + [(None, 1, 0), (1, None, 1), (2, 0, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    for score, none_known in ((toxicity.score_toxicity, labels.limit(0)), (quality.score_quality, labels.limit(0))):
        assert score(docs, labels).count() == len(TEXTS)
        assert {r["score"] < 1e-9 for r in score(docs, none_known).collect()} == {True}


def test_label_model_finds_the_better_voters(spark):
    """Voters that fire with the hidden class get higher rates there than noise, without labels."""
    draw = np.random.default_rng(5)
    hidden = draw.random(4000) < 0.2
    bits = np.zeros((4000, toxicity.LEXICONS + toxicity.PATTERNS), bool)
    for k in range(6):
        bits[:, k] = np.where(hidden, draw.random(4000) < 0.7, draw.random(4000) < 0.02)
    bits[:, 6] = bits[:, 5]
    bits[:, 7] = draw.random(4000) < 0.03
    bits[:, toxicity.LEXICONS] = ~bits[:, :7].any(axis=1)
    votes = (bits * (1 << np.arange(bits.shape[1]))).sum(axis=1)
    tally = Counter(votes.tolist())
    model = toxicity.LabelModel().fit(spark.createDataFrame(list(tally.items()), "votes long, n long"))
    assert (model.fires[1, :6] > 5 * model.fires[0, :6]).all() and model.keep[5] < model.keep[0]
    guess = model.posterior(bits.astype(float)) > 0.5
    assert (guess == hidden).mean() > 0.88 > (~hidden).mean()


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    turns = spark.createDataFrame([], f"conv_id long, turn long, role string, content array<{chat.PART}>")
    for df in (
        toxicity.score_toxicity(none, labels), substrings.dedup_substrings(none), exact.dedup_exact(none), quality.score_quality(none, labels),
        sharding.shard(none), decontaminate.decontaminate(none, bench), extraction.extract_pages(pages),
        mixing.mix(none.selectExpr("doc_id", "source", "0L as size")), simhash.near_duplicates(none), chat.format_chats(turns),
    ):
        assert df.count() == 0
