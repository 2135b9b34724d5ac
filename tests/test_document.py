"""A layout put together as one document."""

import pytest

from quirework.operators import document, layout, units
from quirework.plans.ordered import id_bucket


def put_together(spark, width=1):
    blocks = [
        (1, 0, "text", 120.0, "A short title", 20.0),
        (1, 1, "text", 140.0, "Use the square root rule.", 10.0),
        (1, 2, "text", 180.0, "1\n> quantile(x, 0.99)\n2\n[1] 184704.1", 8.0),
        (1, 3, "text", 300.0, "Figure 1. Prices", 10.0),
        (2, 0, "text", 120.0, "Figure 2. Volumes", 10.0),
        (2, 1, "text", 140.0, "gone", 10.0),
        (2, 2, "text", 160.0, "long " * 40, 20.0),
        (2, 3, "text", 180.0, "> y <- 2", 8.0),
        (2, 4, "text", 200.0, "One.\n\n- a\n- b", 10.0),
        (2, 5, "text", 220.0, "words & more", 14.0),
    ]
    frame = spark.createDataFrame(blocks, "page long, pos long, type string, y0 double, text string, size double").repartition(3)
    answers = spark.createDataFrame(
        [
            ("p1_t1", "1\n> quantile(x)\n2\n[1] 18", 1), ("p1_t3", "Zeichnung 1", 1), ("p1_t3", "Bild 1", 2), ("p2_t1", " ", 1),
            ("p1_t2", "ignored", 1), ("p9_t9", "nowhere", 1),
        ],
        "unit_id string, tr string, latest int",
    )
    assets = spark.createDataFrame(
        [(1, "Figure 1. Prices", "old.png", 1), (1, "Figure 1. Prices", "a.png", 2), (2, "Figure 2. Volumes", "", 1), (1, "Figure 2. Volumes", "no.png", 1)],
        "page long, caption string, asset string, rank int",
    )
    numbered = layout.text_block_ids(frame, ["page"], "pos", "page")
    return document.document_rows(numbered, answers, assets, "page", "pos", id_bucket("page", width))


@pytest.mark.parametrize("width", [1, 100])
def test_document(spark, width):
    rows = {(r.page, r.pos): (r.kind, r.html) for r in put_together(spark, width).collect()}
    assert (1, 1) not in rows, "an answer that turned into a listing"
    assert (2, 1) not in rows, "an empty answer"
    kind, html = rows[1, 0]
    assert kind == "heading" and html.startswith('<h1 id="section-') and html.endswith(">A short title</h1>")
    assert rows[1, 2][0] == "listing" and 'data-code-target="r-code-1"' in rows[1, 2][1] and "[1] 184704.1" in rows[1, 2][1]
    assert 'id="r-code-2"' in rows[2, 3][1] and "&gt; y &lt;- 2" in rows[2, 3][1]
    assert rows[1, 3] == ("figure", '<figure class="book-figure"><img src="a.png" alt="Bild 1"><figcaption>Bild 1</figcaption></figure>')
    assert rows[2, 0] == ("text", "<p>Figure 2. Volumes</p>")
    assert rows[2, 2][0] == "text"
    assert rows[2, 4] == ("text", "<p>One.</p>\n<ul><li>a</li><li>b</li></ul>")
    assert rows[2, 5][1].startswith("<h2 ") and "words &amp; more</h2>" in rows[2, 5][1]


def test_contents_keep_the_first(spark):
    rows = put_together(spark)
    assert [r.rank for r in document.document_contents(rows, "page", "pos").collect()] == [1, 2]
    first = document.document_contents(rows, "page", "pos", 1).collect()
    assert len(first) == 1 and first[0].html.endswith(">A short title</a>")


def test_first_match_of_long_intervals(spark):
    spans = [("k", 2, -5, 10**13), ("k", 1, 100, 100), (None, 0, 0, 9), ("k", 3, None, 5), ("k", 4, 7, 3), ("k", 0, 10**13 + 1, 10**13 + 300)]
    marks = [("k", 1, -6), ("k", 2, -5), ("k", 3, 100), ("k", 4, 10**13), ("k", 5, 10**13 + 300), ("k", 6, None), (None, 7, 5), ("k", 8, 5)]
    points = spark.createDataFrame(marks, "k string, id long, at long")
    found = units.first_match(points, spark.createDataFrame(spans, "k string, n long, a long, b long"), ["k"], "at", "id", "a", "b", "n", ["n"])
    assert {r.id: r.n for r in found.collect()} == {1: None, 2: 2, 3: 1, 4: 2, 5: 0, 6: None, 7: 0, 8: 2}
