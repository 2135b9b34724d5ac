"""Unit pages of a book: order of parts, anchors, missing pages, neighbours, null books; heading repair."""

from quirework.operators import book
from quirework.plans.ordered import id_bucket


def rendered(parts, key, slug):
    rows = [r for r in parts if r["book"] == key and r["slug"] == slug and r["html"] is not None]
    return "\n".join(r["html"] for r in sorted(rows, key=lambda r: (r["part"], r["page"] or 0, r["layer"], r["rank"] or 0)))


def test_unit_parts(spark):
    units = spark.createDataFrame(
        [("b", 1, "a", "A < B", 1, 2), ("b", 2, "c", "C", 2, 3), (None, 1, "x", "X", 1, 1), ("b", 30, "d", "D", 9, 9)],
        "book string, n long, slug string, title string, first_page long, last_page long",
    )
    pages = spark.createDataFrame([("b", 1, '<p id="s1">1</p>'), ("b", 2, "<p>2</p>"), (None, 1, "<p>x</p>")], "book string, page long, html string")
    sections = spark.createDataFrame(
        [("b", "a", 1, 1, "s1"), ("b", "a", 1, 2, "s2"), ("b", "a", 1, 3, ""), ("b", "a", 7, 4, "far"), ("b", "c", 2, 5, "t"), ("b", "c", 3, 6, "u"), (None, "x", 1, 7, "v")],
        "book string, unit string, page long, rank long, slug string",
    )
    for width in (1, 100):
        parts = book.unit_parts(units, pages, sections, ["book"], "n", id_bucket("n", width), "r").collect()
        assert rendered(parts, "b", "a") == (
            '<h1>A &lt; B</h1>\n<span class="section-anchor" id="s2"></span>\n<p id="s1">1</p>\n<p>2</p>\n'
            '<nav class="chapter-nav"><span></span><a href="/r/c/">下一节：C</a></nav>'
        )
        assert rendered(parts, "b", "c") == (
            '<h1>C</h1>\n<span class="section-anchor" id="t"></span>\n<p>2</p>\n'
            '<nav class="chapter-nav"><a href="/r/a/">上一节：A &lt; B</a><a href="/r/d/">下一节：D</a></nav>'
        )
        assert rendered(parts, None, "x") == (
            '<h1>X</h1>\n<span class="section-anchor" id="v"></span>\n<p>x</p>\n<nav class="chapter-nav"><span></span></nav>'
        )
    gone = book.missing_pages(book.unit_parts(units, pages, sections, ["book"], "n", id_bucket("n"), "r"), ["book"]).collect()
    assert sorted((r["slug"], r["page"]) for r in gone) == [("c", 3), ("d", 9)]


def test_heading_repair(spark):
    def page(lead, *rest):
        return '<section class="book-page">' + lead + "".join(rest) + "</section>"

    head, figure = "<h3>2.4 Tail Risk</h3>", "<figure>f</figure>"
    sections = spark.createDataFrame(
        [("u", "s", "2.4 Tail Risk", "2.4 尾部风险", 2, 7), ("u", "t", "2.5 No Page", None, 1, None), (None, "n", "2.4 Tail Risk", None, 1, 1)],
        "unit string, slug string, title_en string, title_zh string, level int, pdf_page int",
    )
    pages = [
        ("u", 6, page(head, "<p>a</p>")), ("u", 7, page(head, "<p>a</p>", "<p>b</p>")), ("u", 8, page("<p>2.4 尾部风险</p>", "<p>a</p>")),
        ("u", 9, page("<h2>2.5 No Page</h2>")), ("u", 10, page(figure)), (None, 8, page(head)), ("v", 8, page(head)), ("u", 11, None),
    ]
    frame = spark.createDataFrame(pages, "unit string, page long, html string")

    def repaired(source):
        sources = spark.createDataFrame([("u", 7, source)], "unit string, page long, text string")
        return {(r.unit, r.page): r.html for r in book.repair_headings(frame, sections, sources, ["unit"]).collect()}

    same = {(u, n): h for u, n, h in pages}
    low = repaired("Here is a whole line of running text.\n2.4 Tail Risk\nMore of it follows below.")
    moved = '<h3 id="s">2.4 尾部风险</h3>'
    assert low == {**same, ("u", 7): page("<p>a</p>", moved + "\n", "<p>b</p>"), ("u", 8): page("", "<p>a</p>")}
    for at_top in ("2.4 Tail Risk\nMore of it follows below.", "No title here at all in this text.", None):
        assert repaired(at_top)["u", 7] == same["u", 7]


def test_source_read_where_the_section_begins(spark):
    sections = spark.createDataFrame(
        [("u", "s", "2.4 Tail Risk", None, 2, 7)], "unit string, slug string, title_en string, title_zh string, level int, pdf_page int"
    )
    heads = spark.createDataFrame([("u", n, "2.4 Tail Risk") for n in (6, 7, 8)], "unit string, page long, text string")
    source = "Here is a whole line of running text.\nAnd one more of the very same kind.\nFig. 1 Loss\n2.4 Tail Risk"
    sources = spark.createDataFrame([("u", n, source) for n in (6, 7, 8)], "unit string, page long, text string")
    found = {r.page: r for r in book.heading_places(heads, sections, sources, ["unit"]).collect()}
    facts = lambda r: (r.near_top, r.blocks, r.after_figure, r.heading)
    assert facts(found[7]) == (False, 1, True, '<h3 id="s">2.4 Tail Risk</h3>')
    assert facts(found[6]) == facts(found[8]) == (None,) * 4 and found[6].section_page == found[8].section_page == 7


def test_ids_of_a_page_are_read_once(spark):
    units = spark.createDataFrame([("b", 1, "a", "A", 1, 1)], "book string, n long, slug string, title string, first_page long, last_page long")
    pages = spark.createDataFrame([("b", 1, "<p>")], "book string, page long, html string")
    sections = spark.createDataFrame([("b", "a", 1, 1, "s")], "book string, unit string, page long, rank long, slug string")
    parts = book.unit_parts(units, pages, sections, ["book"], "n", id_bucket("n"), "r")
    assert parts._jdf.queryExecution().optimizedPlan().toString().count("array_distinct(") == 1
