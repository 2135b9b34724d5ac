import html as stdlib_html

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirework.functions import code as cx
from quirework.functions import html as hx
from quirework.functions import markdown as md
from quirework.functions import paths as px
from quirework.functions import rules as rx
from quirework.functions import text as tx
from quirework.functions import titles

C = F.col


def many(spark, texts, build):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in df.select("i", build(C("t")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "raw, slug",
    [("2023-04-05-Big  News!", "big-news"), ("  机器 Learning ", "机器-learning"), ("!!!", "post"), ("--a--", "a")],
)
def test_slug(value, raw, slug):
    assert value(tx.slugify(C("t")), t=raw) == slug
    assert value(tx.slugify(tx.slugify(C("t"))), t=raw) == slug


def test_slug_variants(value):
    assert value(tx.slugify(C("t"), default="new-post", drop_date=False), t="2023-04-05 x") == "2023-04-05-x"
    assert value(tx.slugify(C("t"), default="new-post", drop_date=False), t="?") == "new-post"


def test_reading_minutes_round_half_even(value):
    assert value(tx.reading_minutes(C("t")), t="w " * 675) == 2
    assert value(tx.reading_minutes(C("t")), t="w " * 1125) == 2
    assert value(tx.reading_minutes(C("t")), t="") == 1
    assert value(tx.reading_units(C("t")), t="**中文** and [a-b](c.d)") == 4


def test_dates(value):
    assert value(tx.date_label(C("t")), t="2021-02-03") == "2021.02.03"
    assert value(tx.date_label(C("t")), t="2021-02-31") == "2021-02-31"
    assert value(tx.feed_date(C("t"), F.lit("2020-01-01").cast("date")), t="soon") == "Wed, 01 Jan 2020 00:00:00 +0800"


def test_line_normalization_matches_python(spark):
    texts = ["", "a", "a \n", "a\t\r\nb \n\n", "\n\n", "x y \x0b z", " lead\n  keep  "]
    want = ["\n".join(line.rstrip() for line in t.splitlines()) + "\n" for t in texts]
    assert many(spark, texts, tx.normalize_lines) == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n\r 　 é中", max_size=20), min_size=30, max_size=30))
def test_white_space_matches_python(spark, texts):
    assert many(spark, texts, tx.squash) == [" ".join(t.split()) for t in texts]
    assert many(spark, texts, tx.strip) == [t.strip() for t in texts]


def test_entities(spark):
    texts = ["a &amp;lt; b", "&quot;x&quot; &copy; &mdash;", "&zzz;", "&eacute; &#233; &hearts;"]
    assert many(spark, texts[:3], tx.decode_entities) == [stdlib_html.unescape(t) for t in texts[:3]]
    assert many(spark, texts, tx.decode_all_entities) == [stdlib_html.unescape(t) for t in texts]


def test_polish_is_ordered(value):
    assert value(tx.polish(C("t"), [("a", "b"), ("b", "c")]), t="ab") == "cc"
    assert value(tx.polish(C("t")), t="甲 ，乙（ 丙 ）") == "甲，乙（丙）"


def test_latex(value):
    assert value(tx.strip_latex(C("t")), t=r"a \(x\) b \[ y" + "\n" + r"\] \begin{equation*}z\end{equation*} c") == "a b c"


def test_visible_text_and_edges(value):
    page = (
        "<!-- <a href='/no'>x</a> --><script>var a='<a href=\"/no\">';</script><style>p{}</style>"
        "<p>Hi &amp; <b>bye</b><a class='k' href='/one'>1</a><A HREF=/two>2</A><a data-href='/no'>3</a>"
        '<img alt="x" src="/i.png"><h2 id="s1">Title</h2><pre>hidden</pre>'
    )
    assert value(hx.visible_text(C("h")), h=page) == "Hi &amp; bye 1 2 3 Title"
    assert value(hx.links(C("h")), h=page) == ["/one", "/two"]
    assert value(hx.images(C("h")), h=page) == ["/i.png"]
    assert value(hx.ids(C("h")), h=page) == ["s1"]
    assert value(hx.visible_blocks(C("h")), h="<p>a</p><li> b  c </li><p></p><p>\\(x\\)</p>") == ["a", "b c"]


def test_toc_needs_three_headings(value):
    two = "<h2>a</h2><h3>b</h3>"
    three = two + '<h2 id="z">c</h2>'
    assert value(hx.article_toc(C("h")), h=two) == []
    assert [(e.anchor, e.nested) for e in value(hx.article_toc(C("h")), h=three)] == [("section-1", False), ("section-2", True), ("z", False)]


def test_fragments(value):
    assert value(hx.namespace_footnotes(C("h"), F.lit(7)), h='<a href="#fn2" id=\'fnref2\'>') == '<a href="#fn-p007-2" id=\'fnref-p007-2\'>'
    assert value(hx.restrict_images(C("h"), ["/ok/"]), h='<img src="/ok/a.png"><img src="/no/b.png"><img alt="c">') == '<img src="/ok/a.png">'
    once = value(hx.ensure_section(C("h"), F.lit(3)), h="x")
    assert once == '<section class="book-page" data-pdf-page="3">\nx\n</section>'
    assert value(hx.ensure_section(C("h"), F.lit(3)), h=once) == once
    assert value(hx.insert_anchors(C("h"), F.array(F.lit("a"), F.lit("b"))), h='<p id="a">') == '<span class="section-anchor" id="b"></span>\n<p id="a">'
    assert value(hx.repair_doctype(C("h")), h="html\n<html>") == "<!doctype html>\n<html>\n"
    assert value(hx.bad_preamble(C("h")), h="<html lang=x>\n") is True
    assert value(hx.bad_preamble(C("h")), h="<!doctype html>\n<html>") is False
    assert value(hx.paragraphs(C("h")), h="a\nb\n\n- x\n- y <z>") == "<p>a b</p>\n<ul><li>x</li><li>y &lt;z&gt;</li></ul>"
    assert value(hx.unwrap_placeholders(C("h")), h="<p> [[CODE_PAIR:a]] </p>") == "[[CODE_PAIR:a]]"


@pytest.mark.parametrize(
    "href, target",
    [
        ("/a/b/", ("/a/b/index.html", "")),
        ("../c.html#top", ("/x/c.html", "top")),
        ("#here", ("/x/y/index.html", "here")),
        ("d%20e+f?q=1", ("/x/y/d e+f/index.html", "")),
        ("https://else.where/x", None),
        ("mailto:a@b.c", None),
        ("//host/x", None),
        ("", None),
        ("../../../up", ("/up/index.html", "")),
    ],
)
def test_local_target(value, href, target):
    got = value(px.local_target(F.lit("/x/y/index.html"), C("h")), h=href)
    assert (tuple(got) if got else None) == target


@pytest.mark.parametrize(
    "href, path",
    [("https://own.site/a/b.html?x#y", "/a/b"), ("https://other.site/a", None), ("c/", "/c"), ("./", "/"), ("#x", "/"), ("", None)],
)
def test_normalize_path(value, href, path):
    assert value(px.normalize_path(C("h"), ["own.site"]), h=href) == path


def test_import_path(value):
    for raw, want in [("index.html", "/"), (r"\root\ch\index.html", "/ch"), ("root/a.html", "/a"), ("b", "/b")]:
        assert value(px.import_path(C("h"), "root"), h=raw) == want
    assert value(px.site_url(F.lit("/"), "root")) == "/root/"
    assert value(px.site_url(F.lit("/a/b"), "root")) == "/root/a-b/"


def test_rules(value):
    assert value(rx.first_finding(C("t"), rx.SYMBOL_ARTIFACTS), t="?????? then ########")["rule"] == "symbol-3"
    assert [f.rule for f in value(rx.findings(C("t"), rx.SYMBOL_ARTIFACTS), t="?????? then ########")] == ["symbol-3", "symbol-7"]
    assert value(rx.first_finding(C("t"), rx.SYMBOL_ARTIFACTS), t="clean") is None
    assert value(rx.hits_any(C("t"), rx.BAD_VISIBLE_TEXT), t="a TODO b") is True
    assert value(rx.hits_any(C("t"), rx.BAD_NOTES), t="uses RStan here") is True
    assert value(rx.hits_any(C("t"), rx.BAD_NOTES), t="uses rstans here") is False
    assert value(rx.hits_any(C("t"), rx.BAD_CODE_PAGE_TEXT), t="x [[CODE_PAIR:a") is True


def test_leaks(value):
    latin, cjk = "abcde " * 16, "中" * 30
    assert value(rx.is_leak(C("t")), t=latin) is True
    assert value(rx.is_leak(C("t")), t="abcde " * 15) is False
    assert value(rx.is_leak(C("t")), t=latin + "中" * 50) is False
    assert value(rx.is_leak(C("t")), t=cjk + " Section ") is True
    assert value(rx.is_leak(C("t")), t="https://host/" + "a" * 200) is False
    assert value(rx.is_leak(C("t")), t="他的家人 " + latin) is False
    assert value(rx.is_allowed_block(C("t")), t="Smith, Journal of Things, 2001") is True
    assert value(rx.is_allowed_block(C("t")), t="EBITDA = x") is True
    assert value(rx.is_allowed_block(C("t")), t="vol. 3, 1999") is True
    assert value(rx.is_allowed_block(C("t")), t="plain words") is False
    reasons = {"x Section": "section_word", latin: "untranslated", latin * 2 + cjk: "mostly_latin", latin + "中" * 50: None, "↩︎ ": None}
    assert {t: value(rx.leak_reason(C("t")), t=t) for t in reasons} == reasons
    named = "中" * 20 + " John Smith"
    kept = {"Working Paper 3": "cited", "p. 3 (1999)": "referenced", "x&nbsp;" + "中" * 10: "spaced", named: "named", named + " should": None, "中" * 19 + " John Smith": None}
    assert {t: value(rx.allowance(C("t")), t=t) for t in kept} == kept


def test_exercise_blocks(value):
    page = '<div class="big exercise">Do <b>it</b> \\(x\\)</div><p>One</p><span class="exercises">no</span><span class=\'exercise\'>Two</span>'
    assert value(hx.visible_blocks(C("h")), h=page) == ["One", "Do it", "Two"]
    assert value(rx.sentence_leaks(C("t")), t="好。 Exercise 3 asks. " + "x" * 10) == ["Exercise 3 asks."]


def test_suspicious_samples(value):
    got = value(rx.suspicious_samples(C("t")), t="before @@3@@ after\nExercise one\nExercise one")
    assert got == ["before @@3@@ after", "Exercise one"]


def test_running_headers(value):
    assert value(rx.is_rendered_header(C("t")), t="12 第 3 章 风险") is True
    assert value(rx.is_source_header(C("t")), t="44 3 Returns and Risk") is True
    assert value(rx.is_source_header(C("t"), sections=False), t="3.1 Data Sources 44") is False
    assert value(rx.is_source_header(C("t")), t="3.1 Data Sources 44") is True
    assert value(rx.is_rendered_header(C("t")), t="plain text") is False


def test_front_matter(value):
    raw = "---\ntitle: \"A: b\"\n# note\n\ntags: [x, 'y']\ntitle: Last\nflag\n---\nBody ---\nmore\n"
    assert value(md.front_matter(C("t")), t=raw) == {"tags": "[x, 'y']", "title": "Last", "flag": ""}
    assert value(md.body(C("t")), t=raw) == "Body ---\nmore"
    assert value(md.has_front_matter(C("t")), t=raw) is True
    assert value(md.has_front_matter(C("t")), t="---\nonly one") is False
    assert value(md.list_value(C("t")), t="[x, 'y', ]") == ["x", "y"]
    assert value(md.scalar_value(C("t"), True), t="one, two") == "['one', 'two']"
    assert value(md.scalar_value(C("t"), False), t="one, two") == "one, two"
    assert value(md.scalar_value(C("t"), True), t="https://a/b,c") == "https://a/b,c"


@pytest.mark.parametrize(
    "text, html",
    [
        ("one\ntwo\n\nthree", "<p>one two</p>\n<p>three</p>"),
        ("## H `c`\n> **q**", "<h2>H <code>c</code></h2>\n<blockquote><strong>q</strong></blockquote>"),
        ("- a\n- b\n1. c\n\nd", "<ul>\n<li>a</li>\n<li>b</li>\n</ul>\n<ol>\n<li>c</li>\n</ol>\n<p>d</p>"),
        ("```py\na < b\n\n# c\n```\nx", "<pre><code>a &lt; b\n\n# c</code></pre>\n<p>x</p>"),
        ("```\n```", "<pre><code></code></pre>"),
        ("x\n```\nlost\n", "<p>x</p>"),
        ("![alt](/p.png)", '<figure class="article-figure"><img src="/p.png" alt="alt" loading="lazy"></figure>'),
        ("[t](/u) *e*", '<p><a href="/u">t</a> <em>e</em></p>'),
        ("##### five", "<p>##### five</p>"),
        ("- a\ntext", "<ul>\n<li>a</li>\n<p>text</p>\n</ul>"),
        ("", ""),
    ],
)
def test_markdown(value, text, html):
    assert value(md.render(C("t")), t=text) == html


def test_code(value):
    pairs = F.array(F.struct(F.lit("p.1").alias("id"), F.lit(" x<-1 ").alias("r_code"), F.lit("y = '[[CODE_PAIR:q]]'").alias("python_code")))
    filled = value(cx.fill_placeholders(C("t"), pairs), t="a [[CODE_PAIR:p.1]] b [[CODE_PAIR:none]] c")
    assert filled.startswith('a <div class="code-tabs" data-code-tabs id="p-1">') and filled.endswith("</div> b  c")
    assert "x&lt;-1</code>" in filled and "[[CODE_PAIR:q]]" in filled
    assert value(cx.rename_lambda(C("t")), t="lambda * 2, lambda x: x, f(lambda)") == "lambda_ * 2, lambda x: x, f(lambda_)"
    assert value(cx.rewrite_calls(C("t")), t="x <- sd(y); set.seed(4)") == "x = np.std(y, ddof=1); rng = np.random.default_rng(4)"
    assert value(cx.tidy_code(C("t")), t="```python\na <- 1  \n```") == "a = 1"
    assert value(cx.without_comments(C("t")), t="a = '#'  # note\nb") == "a = '#'  \nb"
    assert value(cx.syntax_error(C("t")), t="a = (")["line"] == 1
    assert value(cx.syntax_error(C("t")), t="a = 1")["message"] is None


def test_answers(value):
    bad = '{"units": [{"id": "a", "tr": "\\(x\\) \\alpha"}]}'
    assert [tuple(u) for u in value(cx.answer_units(C("t")), t=bad)] == [("a", "\\(x\\) \\alpha")]
    assert [tuple(u) for u in value(cx.answer_units(C("t")), t='{"result": {"units": [{"id": "a", "tr": "x &amp; y"}, {"tr": "z"}]}}')] == [("a", "x & y")]
    assert value(cx.answer_units(C("t")), t="nothing") == []


def test_listing_detection(value):
    for text, want in [
        ("> x <- 1", True), ("12 > plot(x)", True), ("plain words only here", False), ("1\n> x", True),
        ("Figure 3.1 > x", False), ("a <- 1\nlibrary(z)\nwords", False), ("a <- 1\nlibrary(z)\n[1] 3", True),
    ]:
        assert value(cx.code_like_lines(C("t")), t=text) is want, text


def test_titles(value):
    assert value(titles.title_slug(C("t")), t="CHAPTER 07 Cash") == "chapter-7"
    assert value(titles.title_slug(C("t"), "numbered"), t="A.1 I Other") == "a-1-i-other"
    assert value(titles.title_slug(C("t"), "numbered"), t="I Am") == "i-am"
    assert value(titles.title_slug(C("t"), "numbered"), t="3.2.1 Deep") == "section-3-2-1"
    assert value(titles.title_slug(C("t"), "colon"), t="Chapter 4: X") == "chapter-4"
    assert value(titles.section_number(F.lit("x"), C("t")), t="section-b-12-x") == "B.12"
    assert value(titles.canonical_heading(C("t")), t="<b>4.2 The  Copulas</b> 117") == "42thecopula"
    assert value(titles.drop_repeated_heading(C("t"), F.lit("标题：一")), t="<section a><h1>标题 一</h1><h2>标题一</h2>\n<p>x</p>") == "<section a><p>x</p>"
    assert value(titles.has_initial_heading(C("t")), t="<section x><div><h2>a</h2>") is True
    assert value(titles.number_heads_label(C("t"), F.lit("2.1")), t="2.1 a") is True
    assert value(titles.number_heads_label(C("t"), F.lit("2.1")), t="2.10 a") is False
    assert value(titles.drop_running_headers(C("t")), t="中文12 CHAPTER 3 Some Title 续") in ("中文续", "中文12 CHAPTER 3 Some Title 续")
    assert value(titles.is_notice_page(C("t"), ["a notice"]), t="") is False
    assert value(titles.is_notice_page(C("t"), ["a notice"], empty=True), t=" ") is True


def test_sections(value):
    page = '<div class="section level2" id="s1" number="2.1"><h2>Risk &amp; return</h2></div><h2 id="own">Own</h2><h2>none</h2>'
    assert [tuple(x) for x in value(hx.section_links(C("h")), h=page)] == [("s1", "2.1 Risk & return"), ("own", "Own")]
    fixed = value(hx.number_sections(C("h")), h=page)
    assert '<h2>2.1 Risk &amp; return</h2>' in fixed and value(hx.number_sections(C("h")), h=fixed) == fixed


def test_listing_conversion(value):
    def convert(code):
        return value(
            cx.convert_listing(
                C("t"), {"aa": ["import a", "import b"]}, ["import numpy as np"], "# other", "# install", ["%>%"], "# bridged", [("old", "new")]
            ),
            t=code,
        )

    assert convert('library(aa)\nlibrary("zz")\nx <- sd(old)\n#note\ny %>% z') == "import a\nimport b\n# other\n\nx = np.std(new, ddof=1)\n# note\n# bridged"
    assert convert("set.seed(1)\nx") == "import numpy as np\n\nrng = np.random.default_rng(1)\nx"
    assert convert("install.packages('x')") == "# install"
