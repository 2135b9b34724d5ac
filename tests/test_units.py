import random

import pytest
from pyspark.sql import functions as F

from quirework.functions import titles
from quirework.operators import units
from quirework.plans.ordered import id_bucket

OUTLINE = "book string, seq long, id string, parent_id string, level int, title_en string, pdf_page int, slug string, kind string"


def outline(spark):
    return spark.createDataFrame(
        [
            ("b", 1, "o1", None, 0, "Opening words", 3, "opening", "section"),
            ("b", 2, "o2", None, 0, "Contents", 6, "contents", "contents"),
            ("b", 3, "o3", None, 0, "First part", 9, "part-1", "chapter"),
            ("b", 4, "o4", "o3", 1, "1.1 Alpha", 10, "alpha", "section"),
            ("b", 5, "o5", "o3", 1, "1.2 Lost", None, "lost", "section"),
            ("b", 6, "o6", None, 0, "Second part", 9, "part-2", "chapter"),
            ("b", 7, "o7", None, 0, "No page", None, "no-page", "chapter"),
        ],
        OUTLINE,
    )


def spans(df):
    return [(r.slug, r.pdf_page_start, r.pdf_page_end) for r in df.orderBy("id").collect()]


def test_boundary_is_absorbed_or_kept(spark):
    absorbed = units.outline_units(outline(spark), 20, keep_boundary=False)
    assert spans(absorbed) == [("opening", 3, 8), ("part-1", 9, 9), ("part-2", 9, 20)]
    kept = units.outline_units(outline(spark), 20, keep_boundary=True)
    assert spans(kept) == [("opening", 3, 5), ("part-1", 9, 9), ("part-2", 9, 20)]


def test_sections_with_and_without_page(spark):
    def names(df):
        return {r.slug: [s.slug for s in r.sections or []] for r in df.collect()}

    assert names(units.outline_units(outline(spark), 20, keep_boundary=False))["part-1"] == ["alpha", "lost"]
    assert names(units.outline_units(outline(spark), 20, keep_boundary=True))["part-1"] == ["alpha"]


def test_intervals_partition_the_pages(spark):
    rng = random.Random(5)
    starts = sorted(rng.sample(range(1, 400), 40))
    df = spark.createDataFrame([("b", i, p, 400) for i, p in enumerate(starts)], "k string, seq long, p int, last int")
    out = units.unit_intervals(df, ["k"], ["seq"], id_bucket("seq", 7), "p", "last")
    pages = sorted(r.page for r in units.expand(out.select(F.col("p").cast("long").alias("a"), F.col("unit_end").cast("long").alias("b")), "a", "b", step=10).collect())
    assert pages == list(range(starts[0], 401))


def test_clip(spark):
    df = spark.createDataFrame([("a", 1, 10), ("b", 11, 30), ("c", 31, 40)], "s string, pdf_page_start int, pdf_page_end int")
    assert [tuple(r) for r in units.clip_units(df, 25).collect()] == [("a", 1, 10), ("b", 11, 25)]


@pytest.mark.parametrize("width", [3, 1000])
def test_locate_and_first_match(spark, width):
    rng = random.Random(width)
    at, disjoint = 0, []
    for n in range(30):
        at += rng.randint(1, 9)
        end = at + rng.randint(0, 6)
        disjoint.append(("k", n, at, end))
        at = end
    points = [("k", p, p) for p in range(0, at + 5)]
    pdf = spark.createDataFrame(points, "k string, id long, at long")
    sdf = spark.createDataFrame(disjoint, "k string, n long, a long, b long")
    want = {p: next((n for _, n, a, b in disjoint if a <= p <= b), None) for _, p, _ in points}
    out = units.locate(pdf, sdf, ["k"], "at", "id", "a", "b", lambda c: id_bucket(c, width), ["n"])
    assert {r.id: r.n for r in out.collect()} == want

    overlap = [("k", n, (s := rng.randint(0, 200)), s + rng.randint(0, 80)) for n in range(25)]
    odf = spark.createDataFrame(overlap, "k string, n long, a long, b long")
    want = {p: min((n for _, n, a, b in overlap if a <= p <= b), default=None) for _, p, _ in points}
    out = units.first_match(pdf, odf, ["k"], "at", "id", "a", "b", "n", ["n"])
    assert {r.id: r.n for r in out.collect()} == want


@pytest.mark.parametrize("width", [1, 50])
def test_ordinal_pairing(spark, width):
    rows = [("p1", 1, "i"), ("p1", 2, "c"), ("p1", 3, "i"), ("p1", 4, "i"), ("p1", 5, "c"), ("p2", 6, "i"), ("p1", 7, "i")]
    df = spark.createDataFrame(rows, "page string, seq long, kind string")

    def pairs(clamp):
        out = units.pair_by_ordinal(
            df, ["page"], id_bucket("seq", width), ["seq"], F.col("kind") == "i", F.col("kind") == "c", F.col("seq"), clamp
        )
        return {r.seq: r.paired_id for r in out.collect()}

    assert pairs(False) == {1: 2, 3: 5, 4: None, 6: None, 7: None}
    assert pairs(True) == {1: 2, 3: 5, 4: 5, 6: None, 7: 5}


def sequential_slugs(bases):
    seen, out = set(), []
    for base in bases:
        name, n = base, 2
        while name in seen:
            name, n = f"{base}-{n}", n + 1
        seen.add(name)
        out.append(name)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_unique_slugs_match_a_sequential_walk(spark, seed):
    rng = random.Random(seed)
    pool = ["x", "x-2", "x-3", "x-2-2", "x-2-3", "y", "y-2", "z-1", "z-02", "z", "two words", "x-5"]
    bases = ["x", "x", "x-2", "x"] if seed == 0 else [rng.choice(pool) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(bases)), "seq long, base string").repartition(3)
    out = units.unique_slugs(df, [], "base", "seq", id_bucket("seq", 9))
    assert [r.unique_slug for r in out.orderBy("seq").collect()] == sequential_slugs(bases)


def test_tree_paths(spark):
    rows = [("a", None, 1), ("b", "a", 2), ("c", "a", 1), ("d", "c", 1), ("e", None, 0)]
    out = units.flatten_tree(spark.createDataFrame(rows, "n string, p string, o long"), "n", "p", "o")
    assert [r.n for r in out.orderBy("path").collect()] == ["e", "a", "c", "d", "b"]
    assert {r.n: r.depth for r in out.collect()} == {"e": 0, "a": 0, "c": 1, "b": 1, "d": 2}


def test_captions_take_their_next_line(spark):
    lines = [
        (1, 1, "Exhibit 4.2: Cash"), (1, 2, "  by quarter "), (1, 3, "Table 7 Rates"), (1, 4, ""), (1, 5, "Chapter 9 Next"),
        (2, 1, "plain"), (2, 2, "Panel 3 - " + "long " * 40), (2, 3, "tail"),
    ]
    df = spark.createDataFrame(lines, "page int, pos long, text string")
    out = units.find_captions(df, [], "page", "pos", "text")
    got = {(r.page, r.pos): (r.label_type, r.number, r.text_en) for r in out.collect()}
    assert got[1, 1] == ("Exhibit", "4.2", "Exhibit 4.2: Cash by quarter")
    assert got[1, 3] == ("Table", "7", "Table 7 Rates")
    assert got[2, 2][2].startswith("Panel 3 - long") and "tail" not in got[2, 2][2]
    numbered = units.find_captions(df, [], "page", "pos", "text", patterns=(titles.FIGURE_CAPTION, titles.TABLE_CAPTION), stops=(), join_below=180)
    assert [(r.label_type, r.text_en) for r in numbered.collect()] == [("Table", "Table 7 Rates Chapter 9 Next")]


def test_keyed_pair_and_title_maps(spark):
    figures = spark.createDataFrame([(1, "2.1"), (1, "2.2")], "page int, number string")
    caps = spark.createDataFrame([(1, "2.1", 5), (1, "2.1", 8)], "page int, number string, cap long")
    out = units.pair_by_key(figures, caps, ["page", "number"], "cap", "cap")
    assert {r.number: r.paired_id for r in out.collect()} == {"2.1": 8, "2.2": None}
    maps = [spark.createDataFrame([("k", "one")], "s string, t string"), spark.createDataFrame([("k", "two"), ("m", "three")], "s string, t string")]
    assert {r.s: r.t for r in units.merge_title_maps(maps, "s", "t").collect()} == {"k": "one", "m": "three"}
