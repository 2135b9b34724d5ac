from pyspark.sql import functions as F

from quirework.functions import fragments as fr
from quirework.sources import corpus as sources

C = F.col


def test_boilerplate_skips_following_lines(value):
    text = "7\nA notice here\nx1\nx2\nkeep one\n12\nBy Someone Else\ny1\nkeep two\n44 3 Returns and Risk\ndrop me"
    got = value(fr.drop_boilerplate(C("t"), notices=[("a notice", 2)], openings=[("by someone", 1)], dropped=["drop me"]), t=text)
    assert got == "7\nkeep one\nkeep two"


def test_header_elements(value):
    assert value(fr.drop_header_elements(C("t")), t="<p>12 第 3 章 风险</p><h2>真标题</h2><p>a</p>") == "<h2>真标题</h2><p>a</p>"
    assert value(fr.drop_visible_boilerplate(C("t"), ["Some Press"]), t="<p> 41 </p><p>By Some Press, x</p><p>a</p>") == "<p>a</p>"


def test_heading_moves_or_goes(spark):
    page = '<section class="book-page"><h2>2.1 Risk</h2>\n<p>one</p><p>two</p></section>'
    prose = "First, a sentence that is long enough to be prose here."
    rows = [
        ("earlier", page, 9, 8, f"{prose}\n2.1 Risk\nmore"),
        ("top", page, 9, 9, "2.1 Risk\nmore"),
        ("lower", page, 9, 9, f"{prose}\n2.1 Risk\nmore"),
        ("later", page, 9, 10, "x"),
        ("none", page, 9, None, "x"),
    ]
    df = spark.createDataFrame(rows, "k string, h string, page int, at int, src string")
    lines = fr.source_lines(C("src"))
    title = F.lit("2.1 Risk")
    head = fr.section_heading(F.lit(1), F.lit("section-2-1"), F.lit("2.1 风险"))
    out = df.select(
        "k",
        fr.settle_heading(C("h"), C("page"), C("at"), fr.title_near_top(lines, title), head, fr.prose_blocks_before(lines, title), F.lit(False)).alias("o"),
    )
    got = {r.k: r.o for r in out.collect()}
    bare = '<section class="book-page">\n<p>one</p><p>two</p></section>'
    assert got["earlier"] == bare
    assert got["top"] == got["later"] == got["none"] == page
    assert got["lower"] == '<section class="book-page">\n<p>one</p><h2 id="section-2-1">2.1 风险</h2>\n<p>two</p></section>'


def test_images(value):
    images = F.array(
        F.struct(F.lit("/i/a.png").alias("src"), F.lit("3.1").alias("number"), F.lit("A & b").alias("caption")),
        F.struct(F.lit("/i/b.png").alias("src"), F.lit("").alias("number"), F.lit("B").alias("caption")),
    )
    got = value(fr.add_images(C("t"), images), t='<section><img src="/i/b.png"></section>')
    assert got == (
        '<section><img src="/i/b.png">\n<figure class="book-figure" id="fig-3.1"><img src="/i/a.png" alt="A &amp; b" loading="lazy">'
        "<figcaption>A &amp; b</figcaption></figure>\n</section>"
    )
    assert value(fr.add_images(C("t"), images), t=got) == got
    bare = '<figure class="book-figure"><img src="/i/a.png"></figure>'
    tagged = value(fr.add_figure_ids(C("t"), images), t=bare)
    assert tagged == '<figure class="book-figure" id="fig-3.1"><img src="/i/a.png"></figure>'
    assert value(fr.add_figure_ids(C("t"), images), t=tagged) == tagged


def test_code_tabs_come_out(value):
    tabs = '<div class="code-tabs"><div>a</div><div>b</div></div>'
    assert value(fr.lift_code_tabs(C("t")), t=f"x<pre><code>\n{tabs}</code></pre>y") == f"x{tabs}y"
    assert value(fr.lift_code_tabs(C("t")), t=f"<pre><code>{tabs} rest <</code></pre>") == f'{tabs}\n<pre><code class="language-text">rest &lt;</code></pre>'
    assert value(fr.lift_code_tabs(C("t")), t="<pre><code>plain</code></pre>") == "<pre><code>plain</code></pre>"


def test_footnotes_survive(value):
    text = 'a<a class="footnote-ref" href="#1">1</a>b<a class="x">2</a>'
    kept = value(fr.protect_footnotes(C("t")), t=text)
    assert kept["text"] == 'aFOOTNOTEANCHOR000b<a class="x">2</a>'
    assert value(fr.restore_footnotes(C("t"), F.array(F.lit(kept["stash"][0]))), t=kept["text"]) == text
    assert value(fr.restore_footnotes(C("t"), F.array(F.lit("<a>"))), t="lost") == "lost<a>"


def test_small_cleanups(value):
    assert value(fr.number_labels(C("t"), [("Figure ", "图 ")]), t="Figure 3 and Figure x") == "图 3 and Figure x"
    assert value(fr.single_math_marks(C("t")), t=r"\\(x\\)") == r"\(x\)"
    assert value(fr.unescape_attributes(C("t")), t=r"<a href=\"x\">") == '<a href="x">'


def test_links_are_rewritten(spark):
    pages = spark.createDataFrame(
        [(1, "<a href=\"https://own.site/b.html#k\">x</a> <a href='/c'>y</a> <a href=\"#z\">z</a>"), (2, "none")], "id int, h string"
    )
    mapping = spark.createDataFrame([("/b", "/book/b/")], "path string, local_path string")
    out = sources.rewrite_links(pages, mapping, "id", "h", ["own.site"])
    assert {r.id: r.h for r in out.collect()} == {1: "<a href=\"/book/b/#k\">x</a> <a href='/c'>y</a> <a href=\"#z\">z</a>", 2: "none"}


def test_titles_from_json_and_pages(spark):
    guide = '{"list": [{"title_en": "One", "title_zh": "一"}, {"x": {"English": "Two", "Chinese": "二"}}], "Three": "三", "n": 4, "Four": "four"}'
    docs = spark.createDataFrame([("p", guide), ("q", "broken")], "path string, j string")
    got = {(r.title_en, r.title_zh) for r in sources.harvest_titles(docs, "j").collect()}
    assert {("One", "一"), ("Two", "二"), ("Three", "三")} <= got and not any(e == "Four" for e, _ in got)
    pages = spark.createDataFrame([(2, '<h2 id="section-1">后</h2>'), (1, '<h2 id="section-1">先</h2><h3 id="other">它</h3>')], "n int, h string")
    assert [tuple(r) for r in sources.heading_titles(pages, "h", "n").collect()] == [("section-1", "先")]


def test_guide_sample(spark):
    df = spark.createDataFrame([(2, 1, "b"), (1, 0, "a"), (3, 2, "c")], "page int, seq int, src string")
    assert sources.guide_sample(df, "page", "src", ["seq"], count=2).first()["sample"] == "[p1] a\n\n[p2] b"
