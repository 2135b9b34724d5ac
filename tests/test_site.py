import os
import re

import pytest
from pyspark.sql import functions as F

from quirework.operators import site
from quirework.sources import corpus as sources
from quirework.sources import sinks

POSTS = {
    "2024-01-02-first.md": "---\ntitle: First & best\ndate: 2024-01-02\nsummary: one, two\ntags: [Data, 中文]\n---\n# Hi\n\ntext\n",
    "2024-03-01-second.md": "---\ntitle: Second\ndate: 2024-03-01\nslug: Second Post\ntags: Data\nversion: 2\n---\nbody\n",
    "2024-03-01-third.md": "---\ntitle: Third\ndate: 2024-03-01\ntags: [data]\n---\nbody\n",
    "2024-04-01-draft.md": "---\ntitle: Draft\ndraft: TRUE\n---\nbody\n",
    "README.md": "no front matter\n",
}


@pytest.fixture()
def folder(tmp_path):
    root = tmp_path / "posts"
    root.mkdir()
    for name, text in POSTS.items():
        (root / name).write_text(text, encoding="utf-8")
    return str(root)


def read_parts(path):
    out = []
    for base, _, files in sorted(os.walk(path)):
        for name in sorted(files):
            if name.startswith("part-"):
                with open(os.path.join(base, name), encoding="utf-8") as handle:
                    out.append(handle.read())
    return "".join(out)


def test_posts(spark, folder):
    rows = {r.slug: r for r in sources.posts(sources.whole_files(spark, folder, "*.md")).collect()}
    assert set(rows) == {"first", "second-post", "third", "draft"}
    assert rows["first"].tags == ["Data", "中文"] and rows["first"].summary == "one, two"
    assert rows["second-post"].tags == ["Data"] and rows["second-post"].version == "2"
    assert rows["draft"].draft and rows["draft"].date == "2024-04-01" and not rows["first"].draft
    commas = {r.slug: r for r in sources.posts(sources.whole_files(spark, folder, "*.md"), "commas").collect()}
    assert commas["first"].summary == "['one', 'two']"


def test_missing_folder_is_empty(spark, tmp_path):
    assert sources.html_tree(spark, str(tmp_path / "nowhere")).count() == 0


def test_build(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    assert site.build(spark, folder, out, "https://example.org") == 3
    listing = read_parts(f"{out}/listing")
    assert re.findall(r'href="(/posts/[^"]+)"', listing) == ["/posts/second-post/", "/posts/third/", "/posts/first/"]
    first = read_parts(f"{out}/posts/slug=first")
    assert first.startswith("<!doctype html>\n") and "<h1>First &amp; best</h1>" in first and "<h1>Hi</h1>" in first
    # "Data" and "data" share a slug; the last in sorted order owns the page.
    assert "/posts/third/" in read_parts(f"{out}/tags/tag_slug=data") and "/posts/first/" not in read_parts(f"{out}/tags/tag_slug=data")
    feed = read_parts(f"{out}/feed")
    assert feed.count("<item>") == 3 and "Fri, 01 Mar 2024 00:00:00 +0800" in feed and "First &amp; best" in feed
    urls = re.findall(r"<loc>https://example.org([^<]*)</loc>", read_parts(f"{out}/sitemap"))
    assert urls[:7] == ["/", "/posts/", "/tags/", "/about/", "/posts/second-post/", "/posts/third/", "/posts/first/"]
    assert urls[7:] == ["/tags/data/", "/tags/data/", "/tags/中文/"]


def test_build_needs_posts(spark, tmp_path):
    with pytest.raises(ValueError):
        site.build(spark, str(tmp_path), str(tmp_path / "out"), "https://example.org")


PAGES = {
    "index.html": '<!doctype html>\n<html><body><a href="/a/">a</a><a href="a/#in">b</a><a href="a/#out">c</a><a href="gone">d</a>'
    '<img src="/pic.png"><img src="/nopic.png"><a href="https://x.y/z">e</a></body></html>',
    "a/index.html": '<html>\n<body><h2 id="in">T</h2><p>########</p><p>12 第 3 章 风险</p>'
    '<pre><code class="language-python">x &lt;- 1 # &lt;-</code></pre><pre><code class="language-python">y = (</code></pre></body></html>',
}


def test_audit(spark, tmp_path):
    root = tmp_path / "site"
    (root / "a").mkdir(parents=True)
    for name, text in PAGES.items():
        (root / name).write_text(text, encoding="utf-8")
    (root / "pic.png").write_bytes(b"x")
    found = site.audit_site(spark, str(root))
    values = {k: [tuple(r) for r in v.collect()] for k, v in found.items() if k != "report"}
    assert [r[2] for r in values["missing_links"]] == ["gone"]
    assert [r[3] for r in values["missing_anchors"]] == ["a/#out"]
    assert [r[2] for r in values["missing_images"]] == ["/nopic.png"]
    assert values["bad_preambles"] == [("/a/index.html",)]
    assert [r[1] for r in values["rule_hits"]] == ["symbol-3"]
    assert [r[1] for r in values["running_headers"]] == ["12 第 3 章 风险"]
    assert [r[1] for r in values["code_residue"]] == [0] and {r[1] for r in values["code_errors"]} == {1}
    row = found["report"].first()
    assert row.status == "incomplete" and row.missing_links == 1


def test_ordered_text_and_json(spark, tmp_path):
    df = spark.range(100).select(F.lit("u").alias("unit"), "id", F.concat(F.lit("line "), F.col("id").cast("string")).alias("v"))
    sinks.write_ordered_text(df, str(tmp_path / "o"), ["unit"], ["id"], "v")
    text = read_parts(tmp_path / "o")
    assert text.splitlines() == [f"line {i}" for i in range(100)]
    sinks.write_json(df.limit(2), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    (tmp_path / "doc.json").write_text('{\n "a": {"b": [1, 2]}\n}', encoding="utf-8")
    assert sources.json_documents(spark, str(tmp_path / "doc.json"), "a struct<b:array<int>>").first().a.b == [1, 2]


def test_binary_pages_and_images(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"one\x0ctwo")
    (tmp_path / "b.bin").write_bytes(b"bad")

    def extract(content):
        if content == b"bad":
            raise RuntimeError("unreadable")
        return content.decode().split("\x0c")

    files = spark.read.format("binaryFile").load(str(tmp_path))
    rows = sorted((r.page or 0, r.text, r.error) for r in sources.page_texts(files, extract).collect())
    assert rows == [(0, "", "RuntimeError: unreadable"), (1, "one", None), (2, "two", None)]
    images = spark.createDataFrame(
        [("d", 1, 1, "x.PNG", bytearray(b"A")), ("d", 2, 1, "y.jpg", bytearray(b"A")), ("d", 2, 2, "z", bytearray(b"B")), ("d", 3, 1, "e", bytearray(b""))],
        "doc string, page int, index int, name string, content binary",
    )
    out = sorted((r.page, r["index"], r.file_name[-4:], r.is_first) for r in sources.image_placements(images).collect())
    assert out == [(1, 1, ".png", True), (2, 1, ".png", False), (2, 2, ".bin", True)]


def test_layout_documents(spark):
    schema = "path string, pages array<struct<page:int,blocks:array<struct<type:string,bbox:array<double>,text:string,size:double>>,drawings:array<struct<bbox:array<double>>>>>"
    df = spark.createDataFrame([("p", [(1, [("text", [1.0, 2.0, 3.0, 4.0], "hi", 10.0)], [([5.0, 6.0, 7.0, 8.0],)])])], schema)
    assert tuple(sources.layout_blocks(df).first()) == ("p", 1, 0, "text", "hi", 10.0, 1.0, 2.0, 3.0, 4.0)
    assert tuple(sources.layout_drawings(df).first()) == ("p", 1, 0, 5.0, 6.0, 7.0, 8.0)


def test_resume_skips_what_is_answered(spark, tmp_path):
    import json

    from quirework.streaming import resume

    source, store = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    calls = str(tmp_path / "calls")

    def enrich(rows):
        rows.write.mode("append").json(calls)
        return rows.select("page", "input_hash", F.concat(F.lit("tr "), "text").alias("answer"), F.lit(None).cast("string").alias("error"))

    def run(name, rows):
        (source / name).write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")
        resume.run_available(spark, str(source), store, enrich, "v1", str(tmp_path / "checkpoint"))

    run("1.json", [{"page": "a", "text": "x"}, {"page": "b", "text": "y"}])
    run("2.json", [{"page": "a", "text": "x"}, {"page": "c", "text": "z"}])
    assert spark.read.json(calls).count() == 3
    done = resume.read_store(spark, store)
    expected = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "page string")
    row = resume.progress(done, expected).first()
    assert (row.tasks_total, row.tasks_translated, row.tasks_pending) == (4, 3, 1)
