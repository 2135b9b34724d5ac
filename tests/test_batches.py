from pyspark.sql import functions as F

from quirework.functions import html as hx
from quirework.operators import audit, batches
from quirework.operators import indicators as ind


def test_cascade_through_a_client(spark):
    class Flaky:
        """Fails the first call, loses odd ids in batches."""

        def __init__(self):
            self.calls = 0

        def answer(self, ids, texts):
            self.calls += 1
            if self.calls == 1:
                raise TimeoutError("slow")
            return {i: t.upper() for i, t in zip(ids, texts) if len(ids) == 1 or i % 2 == 0}

    df = spark.createDataFrame([(i, f"t{i}", i // 3) for i in range(7)], "id long, t string, b long")
    done = batches.cascade(
        df, "id", [("batch", lambda p: batches.call_batches(p, "id", "t", ["b"], Flaky)), ("single", lambda p: batches.call_singles(p, "id", "t", Flaky))]
    )
    rows = {r.id: (r.answer, r.stage, r.error) for r in done.collect()}
    assert len(rows) == 7
    assert all(rows[i] == (f"T{i}", "batch" if i % 2 == 0 else "single", None) for i in range(7))


def test_failures_are_rows(spark):
    class Broken:
        def answer(self, ids, texts):
            raise ValueError("no")

    df = spark.createDataFrame([(1, "a")], "id long, t string")
    row = batches.cascade(df, "id", [("strict", lambda p: batches.call_singles(p, "id", "t", Broken))]).first()
    assert row.answer is None and row.error == "ValueError: no"


def test_cache_needs_same_hash_and_content(spark):
    requests = spark.createDataFrame([(1, "h1"), (2, "h2"), (3, "h3")], "id int, h string")
    cache = spark.createDataFrame([(1, "h1", "ok"), (2, "old", "ok"), (3, "h3", " ")], "id int, h string, a string")
    hit, missing = batches.split_cached(requests, cache, ["id", "h"], "a")
    assert [r.id for r in hit.collect()] == [1]
    assert sorted(r.id for r in missing.collect()) == [2, 3]


def test_cache_key_is_unambiguous(value):
    keys = {value(batches.cache_key(F.lit(a), F.lit(b))) for a, b in [("ab", "c"), ("a", "bc"), ("abc", ""), ("", "abc")]}
    assert len(keys) == 4
    assert value(batches.cache_key(F.lit("a"), F.lit(None))) != value(batches.cache_key(F.lit("a"), F.lit("")))


def test_small_helpers(spark):
    assert [batches.code_batch_size(n) for n in (0, 3, 9)] == [1, 3, 4]
    expected = spark.createDataFrame([(1,), (2,)], "id int")
    assert [r.id for r in batches.missing_ids(expected, expected.filter("id = 1"), "id").collect()] == [2]


def test_document_report(spark):
    html = 'x <div class="r-code-card"><button class="copy-code"></div> data:image/png;base64,TODO"'
    pages = spark.createDataFrame([(1, html)], "id int, h string")
    good = audit.document_report(pages, F.col("h"), pages, pages, "id", ["Data source:"]).first()
    assert good.status == "ready" and good.todo_markers == 0 and good.code_cards == good.copy_buttons == 1
    bad = audit.document_report(pages.withColumn("h", F.concat("h", F.lit(" 待翻译 Data source: x"))), F.col("h"), pages, pages.filter("id = 2"), "id", ["Data source:"]).first()
    assert (bad.status, bad.todo_markers, bad.red_flags, bad.missing_answers) == ("fail", 1, 1, 1)


def test_page_rules(value):
    css = '<link rel="x" href="/assets/css/site.css{}"><script src="/assets/js/site.js?v=1"></script>'
    check = lambda h: value(audit.unversioned_assets(F.col("h"), "/assets/css/site.css", "/assets/js/site.js"), h=h)
    assert check(css.format("?v=a1")) == [] and check(css.format("")) == ["/assets/css/site.css"] and check(css.format("?v=")) == ["/assets/css/site.css?v="]
    side = '<aside class="a tutorial-sidebar"><button data-sidebar-action="expand">{}</aside>'
    assert value(audit.lacks_sidebar_controls(F.col("h")), h=side.format("")) is True
    assert value(audit.lacks_sidebar_controls(F.col("h")), h=side.format('<b data-sidebar-action="collapse">')) is False
    section = '<div class="section level2" number="2.1"><h2>{}</h2></div><div class="section" number="3"><h2>x</h2></div>'
    assert value(audit.unnumbered_sections(F.col("h")), h=section.format("2.1 a")) == []
    assert value(audit.unnumbered_sections(F.col("h")), h=section.format("a")) == ["2.1"]
    assert value(audit.nested_code_tabs(F.col("h")), h='<pre><code> <div id="x" class="code-tabs">') is True
    assert value(hx.code_in_language(F.col("h"), "python"), h='<code class="x language-python">a &lt; b</code><code class="language-r">c</code>') == ["a < b"]


def test_misplaced_headings(spark):
    page = '<section class="book-page" data-pdf-page="9"><h2>2.1 Risk</h2></section><section class="book-page" data-pdf-page="8"><h2>2.1 Risk</h2></section>'
    pages = spark.createDataFrame([("u", page)], "unit string, h string")
    sections = spark.createDataFrame([("u", "s21", "2.1 Risk", "2.1 风险", 8)], "unit string, slug string, title_en string, title_zh string, pdf_page int")
    out = audit.misplaced_headings(pages, sections, ["unit"], "h").collect()
    assert [(r.page, r.section_slug) for r in out] == [(9, "s21")]


def test_misplaced_headings_reads_a_source_once(spark):
    pages = spark.createDataFrame([("u", "<p>")], "unit string, h string")
    sections = spark.createDataFrame([("u", "s", "a", "b", 8)], "unit string, slug string, title_en string, title_zh string, pdf_page int")
    sources = spark.createDataFrame([("u", 8, "a")], "unit string, page long, text string")
    out = audit.misplaced_headings(pages, sections, ["unit"], "h", sources)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("coalesce(__source") == 1


def test_misplaced_headings_meet_the_sections_in_one_join(spark):
    page = lambda unit, number: (unit, f'<section class="book-page" data-pdf-page="{number}"><h2>2.1 Risk</h2></section>')
    pages = spark.createDataFrame([page(u, n) for u in ("u", None) for n in (7, 8, 9)], "unit string, h string")
    sections = spark.createDataFrame(
        [("u", "s21", "2.1 Risk", None, 8), (None, "s22", "2.1 Risk", None, 8)], "unit string, slug string, title_en string, title_zh string, pdf_page int"
    )
    late = "Here is a whole line of running text, which goes on.\n2.1 Risk"
    sources = spark.createDataFrame([("u", 8, late), ("u", 9, "x"), ("u", 9, "y"), (None, 8, "2.1 Risk")], "unit string, page long, text string")
    out = audit.misplaced_headings(pages, sections, ["unit"], "h", sources)
    # One join of the sections with their sources, one of the heads; a null unit is one more unit.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
    assert sorted((r.unit or "", r.page, r.section_slug) for r in out.collect()) == [("", 9, "s22"), ("u", 8, "s21"), ("u", 9, "s21")]


def test_indicators_by_hand(spark):
    bars = spark.createDataFrame(
        [("s", 1, 10.0, 12.0, 9.0, 10.0, 100), ("s", 2, 10.0, 13.0, 10.0, 12.0, 150), ("s", 3, 12.0, 12.0, 12.0, 12.0, 120), ("s", 4, 12.0, 12.0, 8.0, 9.0, 90)],
        "symbol string, day int, open double, high double, low double, close double, volume long",
    )
    pick = lambda df, c: [r[c] for r in df.orderBy("day").collect()]
    assert pick(ind.obv(bars), "obv") == [0, 150, 150, 60]
    assert pick(ind.vpt(bars), "vpt") == [0.0, 30.0, 30.0, 7.5]
    assert pick(ind.wad(bars), "wad") == [0.0, 2.0, 2.0, -1.0]
    assert pick(ind.wvad(bars), "wvad")[2] is None
    indexes = ind.volume_indexes(bars)
    assert pick(indexes, "pvi") == [0.0, 0.2, 0.2, 0.2] and pick(indexes, "nvi") == [0.0, 0.0, 0.0, -0.25]
    assert pick(ind.facilitation(bars), "mfi")[0] == 0.03
