"""Elements of pages: nested, unclosed and stray tags; removal; translation that keeps what it has no answer for."""

import json

import pytest

from quirework.operators import batches, units
from quirework.operators import elements as el


def pages(spark, *htmls):
    return spark.createDataFrame([(i, h, "x") for i, h in enumerate(htmls)], "page_id long, html string, row string")


def texts(spark, *htmls, **options):
    return {r.page_id: r.text for r in el.outer_text(pages(spark, *htmls), **options).collect()}


def test_outermost_blocks(spark):
    got = texts(
        spark,
        "<ul><li>a<ul><li>b</li><li>c</li></ul>d</li><li>e</li></ul>",
        "<p>one<p>two<b>three<div>free</div><p>four",  # end tags missing: the next block's tag ends them
        "</p><p>x</p></p></li>y<p>z</p>",  # stray end tags
        "<div class='note example big'>t <p>u</p> v</div><div>w</div><p>a &amp; b<script>if (a < b) '<p>'</script> c</p>",
        "<p>say <code>f(<p>x)</code> so</p>",
        "<table><tr><td><p>1</p></td><td>2</td></tr></table> out <p></p><p> \n </p>",
        None, "", "1 < 2 <p>3 < 4</p>",
    )
    assert got == {0: "a b c d\ne", 1: "one\ntwo three\nfour", 2: "x\nz", 3: "t u v\na & b c", 4: "say", 5: "1 2", 6: "", 7: "", 8: "3 < 4"}


def test_rows_with_one_key_stay_apart(spark):
    frame = spark.createDataFrame([(1, "<p>a</p>"), (1, "<p>b</p>"), (None, "<p>c</p>"), (None, "<p>d</p>")], "page_id long, html string").repartition(3)
    assert sorted(r.text for r in el.outer_text(frame).collect()) == ["a", "b", "c", "d"]


def test_clean_body(spark):
    def cleaned(html, **options):
        return tuple(el.clean_body(pages(spark, html), **options).select("root", "body").first())

    roots = [("section", "normal"), ("body", None)]
    html = '<body><nav>n</nav><section class="a normal"><h1>Site &amp; Co</h1>x<div class="ad">1<div>2<div class="ad">3</div></div>4</div>y<br/>z</section>t</body>'
    assert cleaned(html, roots=roots, drop_tags=["nav"], drop_classes=["ad"], title="Site & Co") == ("section.normal", '<section class="a normal">xy<br/>z</section>')
    assert cleaned(html, roots=roots[1:], drop_tags=["section"]) == ("body", "<body><nav>n</nav>t</body>")
    assert cleaned("<i>a</i> b", roots=roots) == ("", "<i>a</i> b")
    twice = '<div><pre class="src">a</pre> <pre class="src r">b</pre><pre class="src">c</pre>x<pre class="src">d</pre><p></p><pre class="src">e</pre></div>'
    assert cleaned(twice, roots=roots, repeated_classes=["src"])[1] == '<div><pre class="src">a</pre> x<pre class="src">d</pre><p></p><pre class="src">e</pre></div>'
    # An element without end tag goes as far as the next block.
    assert cleaned('<body><p class="ad">a <b>b<p>c</body>', roots=roots, drop_classes=["ad"])[1] == "<body><p>c</body>"
    assert el.clean_body(pages(spark, None, ""), roots).select("body").collect() == [("",), ("",)]


NOTE = '<a class="footnote-ref" href="#n1">1</a>'


def test_translation_keeps_the_rest(spark):
    html = f'<body>\n<h1>Head</h1> loose <p class="x">One{NOTE} two</p><p>12 34</p><ul><li>Item <table><tr><td>cell</td></tr></table></li><li>  last<!-- c --> </li></ul><pre><p>code</p></pre>< &'
    frame = pages(spark, html, None, "", "<p>only")
    pieces = el.block_pieces(frame)
    blocks = [(r.page_id, r.block, r.text) for r in pieces.filter("inside").orderBy("page_id", "block").collect()]
    assert blocks == [(0, 1, "Head"), (0, 2, f"One{NOTE} two"), (0, 3, "cell"), (0, 4, "  last<!-- c --> "), (3, 1, "only")]
    for r in pieces.collect():
        source = [html, None, "", "<p>only"][r.page_id]
        assert r.text == (source or "")[r.offset : r.offset + r.length]
    none = spark.createDataFrame([], "page_id long, block long, answer string, sequence long")
    assert {r.page_id: r.html for r in el.translate_blocks(pieces, none).collect()} == {0: html, 1: "", 2: "", 3: "<p>only"}
    rows = [(0, 1, "früher", 1), (0, 1, "Kopf", 2), (0, 2, "Eins FOOTNOTEANCHOR000 zwei", 1), (0, 4, "", 1), (0, 9, "no such block", 1), (3, 1, "nur", 1)]
    got = {r.page_id: (r.html, r.blocks, r.translated) for r in el.translate_blocks(pieces, spark.createDataFrame(rows, none.schema)).collect()}
    assert got[0] == (html.replace("Head", "Kopf").replace(f"One{NOTE} two", f"Eins {NOTE} zwei"), 4, 2) and got[3] == ("<p>nur", 1, 1)
    lost = spark.createDataFrame([(0, 2, "Eins", 1)], none.schema)
    assert el.translate_blocks(pieces, lost).filter("page_id = 0").first().html == html.replace("One" + NOTE + " two", "Eins" + NOTE)


# nested outlines

def walk(outline):
    out = []

    def visit(entries, level, parent):
        last = parent
        for e in entries:
            if isinstance(e, list):
                visit(e, level + 1, last)
            elif isinstance(e, dict):
                out.append([f"outline-{len(out) + 1:04d}", parent, level, e.get("title", ""), e.get("page") if isinstance(e.get("page"), int) else None])
                last = out[-1][0]

    visit(outline, 0, None)
    return out


def deep(n):
    out = [{"title": f"t{n}"}]
    for k in range(n, 0, -1):
        out = [{"title": f"t{k}", "page": k}, out]
    return out


@pytest.mark.parametrize("outline", [
    [], [{"title": "a", "page": 1}, [{"title": "b"}, [{"title": "c", "page": "x"}], {"title": "d", "page": 3}, [{"title": "e"}]], {"title": "f"}],
    [[{"title": "first"}], {"title": "x"}, [], [[{"title": "two down"}]], [{"title": "y"}]], deep(9), [{"page": 4}, [{"title": " a\n b "}]],
])
def test_nested_outline(spark, outline):
    frame = spark.createDataFrame([("k", json.dumps(outline)), (None, json.dumps(outline))], "book string, outline string")
    found, errors = units.flatten_outline(frame, "book", "outline")
    want = [tuple(x[:3] + [" ".join(x[3].split())] + x[4:]) for x in walk(outline)]
    for book in ("book = 'k'", "book IS NULL"):
        rows = found.filter(book).orderBy("seq").select("id", "parent_id", "level", "title_en", "pdf_page").collect()
        assert [tuple(r) for r in rows] == want
    assert errors.count() == 0


def test_outline_errors_stay_rows(spark):
    frame = spark.createDataFrame([(1, '[{"title": "a"}, 7, [null, {"title": "b"}]]'), (2, "{not json"), (3, '{"title": "no list"}'), (4, None)], "book long, outline string")
    found, errors = units.flatten_outline(frame, "book", "outline")
    assert [(r.id, r.parent_id, r.title_en) for r in found.orderBy("seq").collect()] == [("outline-0001", None, "a"), ("outline-0002", "outline-0001", "b")]
    assert sorted((r.book, r.path, r.error) for r in errors.collect()) == [
        (1, [1], "neither item nor list"), (1, [2, 0], "neither item nor list"), (2, [], "no list"), (3, [], "no list"), (4, [], "no list"),
    ]


def test_outline_moves_once(spark):
    found, _ = units.flatten_outline(spark.createDataFrame([(1, '[{"title": "a"}, [{"title": "b"}]]')], "book long, outline string"), "book", "outline")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


# titles of sections

@pytest.mark.parametrize("slug, english, known, want", [
    ("section-8-1", "8.1 Introduction", {"section-8-1": "第8章 Copula"}, ("8.1 引言", "common", "wrong number")),
    ("section-9-3", "9.3 Multiple Linear Regression", {"section-9-3": "9.3 Multiple Linear Regression"}, ("9.3 多元线性回归", "common", "untranslated")),
    ("section-a-2", "A.2 Probability Distributions", {}, ("A.2 概率分布", "common", None)),
    ("section-2-2", "2.2 Unheard of", {"section-2-2": "第二章"}, ("2.2 Unheard of", "english", "wrong number")),
    ("section-2-3", "2.3 Unheard of", {"section-2-3": "2.3 Kept"}, ("2.3 Kept", "slug", None)),
    ("x", "Preface", {"Preface": "前言"}, ("前言", "title", None)),
    (None, "INTRODUCTION ", {}, ("引言", "common", None)),
])
def test_section_titles(spark, slug, english, known, want):
    sections = spark.createDataFrame([(1, slug, english)], "n long, slug string, title_en string")
    by_slug = spark.createDataFrame([(k, v) for k, v in known.items()], "slug string, title string")
    common = [("introduction", "引言"), ("multiple linear regression", "多元线性回归"), ("probability distributions", "概率分布")]
    rows = units.section_titles(sections, by_slug, by_slug.withColumnRenamed("slug", "title_en"), spark.createDataFrame(common, "words string, title string"), ["n"])
    assert tuple(rows.select("title", "source", "rejected").first()) == want


# null keys and wide intervals

def test_null_keys_are_keys(spark):
    requests = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, n int")
    cache = spark.createDataFrame([(None, "x"), ("a", "y"), ("b", " ")], "k string, answer string")
    answered, missing = batches.split_cached(requests, cache, ["k"], "answer")
    assert {(r.k, r.n, r.answer) for r in answered.collect()} == {(None, 1, "x"), ("a", 2, "y")} and [r.k for r in missing.collect()] == ["b"]
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(None, 1, "i"), (None, 2, "c"), (None, 3, "i"), ("p", 1, "i"), ("p", 2, "c")], "page string, n long, kind string")
    paired = units.pair_by_ordinal(rows, ["page"], F.lit(0), ["n"], F.col("kind") == "i", F.col("kind") == "c", F.col("n"))
    assert {(r.page, r.n, r.paired_id) for r in paired.collect()} == {(None, 1, 2), (None, 3, None), ("p", 1, 2)}


def test_intervals_of_any_width(spark):
    spans = [("k", 1, 0, 2**45), ("k", 0, -(2**62), -5), (None, 2, 5, 2**61), ("k", 3, -4, -4)]
    points = [(i, k, p) for i, (k, p) in enumerate([("k", 0), ("k", 2**45), ("k", 2**45 + 1), ("k", -(2**62)), ("k", -5), ("k", -4), (None, 2**61), (None, 4), ("q", 7), ("k", None)])]
    found = units.first_match(
        spark.createDataFrame(points, "id long, k string, at long"), spark.createDataFrame(spans, "k string, n long, a long, b long"), ["k"], "at", "id", "a", "b", "n", ["n"]
    )
    assert {r.id: r.n for r in found.collect()} == {0: 1, 1: 1, 2: None, 3: 0, 4: 0, 5: 3, 6: 2, 7: None, 8: None, 9: None}
    empty = units.first_match(spark.createDataFrame(points[:1], "id long, k string, at long"), spark.createDataFrame([], "k string, n long, a long, b long"), ["k"], "at", "id", "a", "b", "n", ["n"])
    assert [r.n for r in empty.collect()] == [None]


def test_token_partitions_follow_the_text(spark, monkeypatch):
    frame = pages(spark, *["<p>" + "a" * 93 + "</p>"] * 20, None)
    monkeypatch.setattr(el, "PART_CHARS", 100)
    assert el.token_parts(frame) == 20 and el.token_parts(frame.limit(0)) == 1
    plan = el.outer_text(frame)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning(row#") == 1
