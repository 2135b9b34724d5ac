"""Refresh by change set, and the table it is published to: equal to a full rendering, no leftovers, safe reruns."""

import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from quirework.operators import refresh
from quirework.plans.ordered import id_bucket
from quirework.sources import versions
from quirework.sources.versions import Versions

PAGES = "book string, n long, slug string, title string, body string, other int"


def made(spark, rows, links, stored, version="1"):
    pages = spark.createDataFrame([(*r, 1) for r in rows], PAGES)
    references = spark.createDataFrame(links, "book string, slug string, target string")
    return refresh.delta(pages, references, stored, ["book"], "n", id_bucket("n", 2), version, lambda: refresh.unit_page("r"))


FIRST = [("b", 1, "a", "A", "x"), ("b", 2, "c", "C < D", "y"), ("b", 3, "d", None, None), ("b", 9, "e", "E", "z"), ("b", 10, "f", "F", "v"), (None, 1, "a", "N", "w")]
LINKS = [("b", "a", "f"), ("b", "a", "f"), ("b", "a", "gone"), (None, "a", "f")]


def states(rows):
    return {(r.book, r.slug): r.state for r in rows}


def html(frame):
    return {(r.book, r.slug): r.html for r in frame.collect()}


def test_change_set(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "t"), ["book", "slug"])
    assert store.rows() is None
    first = made(spark, FIRST, LINKS, None)
    assert set(states(first.collect()).values()) == {refresh.ADDED}
    assert store.publish(first) == 1
    pages = html(store.rows())
    assert pages["b", "a"] == (
        '<h1>A</h1>x<ul class="references"><li><a href="/r/f/">F</a></li><li><a href="/r/gone/">gone</a></li></ul>'
        '<nav class="chapter-nav"><span></span><a href="/r/c/">下一节：C &lt; D</a></nav>'
    )
    assert pages["b", "d"] == '<h1>d</h1><nav class="chapter-nav"><a href="/r/c/">上一节：C &lt; D</a><a href="/r/e/">下一节：E</a></nav>'
    assert pages[None, "a"] == '<h1>N</h1>w<ul class="references"><li><a href="/r/f/">f</a></li></ul><nav class="chapter-nav"><span></span></nav>'

    # f gets another title, which a shows and e has beside it; d goes, between c and e.
    later = [*FIRST[:2], FIRST[3], ("b", 10, "f", "F2", "v"), FIRST[5]]
    second = made(spark, later, LINKS, store.manifest().drop("part"))
    expected = {("b", "a"): "changed", ("b", "c"): "changed", ("b", "d"): "removed", ("b", "e"): "changed", ("b", "f"): "changed", (None, "a"): "same"}
    found = second.collect()
    assert states(found) == expected
    assert {(r.book, r.slug) for r in found if r.html is not None} == {k for k, v in expected.items() if v == "changed"}
    assert store.publish(second) == 2
    full = html(made(spark, later, LINKS, None))
    assert html(store.rows()) == full
    assert set(states(made(spark, later, LINKS, store.manifest().drop("part")).collect()).values()) == {"same"}
    assert set(states(made(spark, later, LINKS, store.manifest().drop("part"), "2").collect()).values()) == {"changed"}
    # The first part still holds the page that stayed; old manifests and commits are gone.
    assert len(os.listdir(tmp_path / "t/parts")) == 2
    assert [n for n in os.listdir(tmp_path / "t/commits") if not n.startswith(".")] == ["2"] and len(os.listdir(tmp_path / "t/manifests")) == 1

    # Everything goes.
    assert store.publish(made(spark, [], [], store.manifest().drop("part"))) == 3
    assert store.rows().count() == 0 and len(os.listdir(tmp_path / "t/parts")) == 1
    assert store.publish(made(spark, later, LINKS, store.manifest().drop("part"))) == 4
    assert html(store.rows()) == full


def test_broken_and_rival_runs(spark, tmp_path, monkeypatch):
    store = Versions(spark, str(tmp_path / "t"), ["book", "slug"])
    first = made(spark, FIRST, LINKS, None)
    broken = first.withColumn("html", F.when(F.col("slug") == "e", F.raise_error(F.lit("lost"))).otherwise(F.col("html")))
    with pytest.raises(Exception, match="lost"):
        store.publish(broken)
    assert store.rows() is None
    store.publish(first)
    before = html(store.rows())
    with pytest.raises(Exception, match="lost"):
        store.publish(broken.withColumn("state", F.lit("changed")))
    # Readers still see the whole first state, and the next run leaves one part.
    assert html(store.rows()) == before
    monkeypatch.setattr(Versions, "_commit", lambda self: (0, None))
    with pytest.raises(Py4JJavaError, match="exists"):
        store.publish(first)
    monkeypatch.undo()
    assert html(store.rows()) == before
    store.publish(made(spark, FIRST, LINKS, None, "2"))
    assert html(store.rows()) == before and len(os.listdir(tmp_path / "t/parts")) == 1


def test_parts_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "MOST_PARTS", 2)
    store = Versions(spark, str(tmp_path / "t"), ["k"])
    rows = spark.createDataFrame([(k, "f", f"h{k}") for k in range(6)], "k long, fingerprint string, html string")
    for done in range(6):
        state = F.when(F.col("k") < done, "same").otherwise("added")
        store.publish(rows.filter(F.col("k") <= done).withColumn("state", state))
        assert len(os.listdir(tmp_path / "t/parts")) <= 2
    assert {r.k: r.html for r in store.rows().collect()} == {k: f"h{k}" for k in range(6)}
