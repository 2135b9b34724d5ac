"""Whole-site jobs: build the pages of a post folder, audit a folder of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import html as hx
from quirework.functions import markdown as md
from quirework.functions import rules as rx
from quirework.functions import text as tx
from quirework.operators import audit, corpus
from quirework.plans.ordered import RowNumber, ordered_scan
from quirework.session import materialize
from quirework.sources import corpus as sources
from quirework.sources import sinks


def shell(title: Column, description: Column, content: Column) -> Column:
    """A page around its content."""
    return F.concat(
        F.lit('<!doctype html>\n<html lang="zh-CN">\n<head>\n<meta charset="utf-8">\n<title>'), tx.escape_html(title),
        F.lit('</title>\n<meta name="description" content="'), tx.escape_html(description),
        F.lit('">\n</head>\n<body>\n'), content, F.lit("\n</body>\n</html>\n"),
    )


def tag_links(tags: Column) -> Column:
    link = lambda t: F.concat(
        F.lit('<a class="tag" href="/tags/'), tx.slugify(t), F.lit('/">'), tx.escape_html(t), F.lit("</a>")
    )
    return F.array_join(F.transform(tags, link), "")


def card(post_url: Column) -> Column:
    """Listing card of a post; title and tags are carried in lower case for the search."""
    return F.concat(
        F.lit('<article class="post-card" data-title="'), tx.escape_html(F.lower("title")),
        F.lit('" data-tags="'), tx.escape_html(F.lower(F.array_join("tags", " "))),
        F.lit('"><a href="'), post_url, F.lit('">'), tx.escape_html(F.col("title")), F.lit("</a><time>"),
        tx.date_label(F.col("date")), F.lit("</time><p>"), tx.escape_html(F.col("summary")), F.lit("</p>"),
        tag_links(F.col("tags")), F.lit("</article>"),
    )


def post_page() -> Column:
    badge = tx.version_label(F.col("version"))
    head = F.concat(
        F.lit('<article class="article-shell">\n<header>'), tag_links(F.col("tags")), F.lit("\n<h1>"), tx.escape_html(F.col("title")),
        F.lit('</h1>\n<time datetime="'), tx.escape_html(F.col("date")), F.lit('">'), tx.date_label(F.col("date")), F.lit("</time>"),
        F.when(badge == "", F.lit("")).otherwise(F.concat(F.lit('<span class="version-badge">'), tx.escape_html(badge), F.lit("</span>"))),
        F.lit("<span>"), tx.reading_minutes(F.col("body")).cast("string"), F.lit(" 分钟读完</span></header>\n"),
        F.lit('<img class="article-cover" src="'), tx.escape_html(F.col("cover")), F.lit('" alt="">\n<div class="article-body">\n'),
    )
    return shell(F.col("title"), F.col("summary"), F.concat(head, md.render(F.col("body")), F.lit("\n</div>\n</article>")))


def build(spark: SparkSession, posts_folder: str, out: str, site: str, coercion: str = "safe", pages: DataFrame | None = None) -> int:
    """Posts, listings, tags, feed and site map below ``out``; returns the number of posts.

    Listings are written as ordered rows, so neither a long listing nor a hot tag is
    gathered in one place.  ``pages`` adds addresses (url) of finished book pages.
    """
    found = sources.posts(sources.whole_files(spark, posts_folder, "*.md"), coercion)
    live = materialize(corpus.published(found))
    count = live.count()
    if count == 0:
        raise ValueError("no published posts")

    # Newest first by the date as it is written; equal dates keep the order of their file names.  The range of a
    # sort gives the stretch of each post, so no day is walked by one task.
    parts = spark.sparkContext.defaultParallelism
    spread = live.repartitionByRange(parts, F.desc("date"), F.asc("path")).sortWithinPartitions(F.desc("date"), F.asc("path"))
    walked = materialize(spread.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at")))
    by_date = ordered_scan(walked, [], F.col("__part"), ["__at"], RowNumber("position")).drop("__part", "__at")
    listed = materialize(by_date.withColumn("url", F.concat(F.lit("/posts/"), "slug", F.lit("/"))).withColumn("card", card(F.col("url"))))

    sinks.write_documents(live.withColumn("html", post_page()), f"{out}/posts", "slug", "html", html=True)
    sinks.write_ordered_text(listed, f"{out}/listing", [], ["position"], "card")
    home = listed.filter(F.col("position") <= corpus.HOME_CARDS)
    sinks.write_ordered_text(home, f"{out}/home", [], ["position"], "card")

    tagged = listed.select("position", "card", F.explode("tags").alias("tag")).withColumn("tag_slug", tx.slugify(F.col("tag")))
    counts = corpus.tag_counts(tagged)
    owners = corpus.tag_page_owner(counts).select("tag", "tag_slug")
    sinks.write_ordered_text(tagged.join(owners, ["tag", "tag_slug"], "left_semi"), f"{out}/tags", ["tag_slug"], ["position"], "card")
    tag_cards = counts.select(
        "tag",
        F.concat(
            F.lit('<a class="tag-card" href="/tags/'), "tag_slug", F.lit('/"><strong>'), tx.escape_html(F.col("tag")), F.lit("</strong><span>"),
            F.col("posts").cast("string"), F.lit(" 篇</span></a>"),
        ).alias("card"),
    )
    sinks.write_ordered_text(tag_cards, f"{out}/tag-index", [], ["tag"], "card")

    items = corpus.feed(listed, site, [F.asc("position")])
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "item"))), lambda s: s["item"]), "\n")
    channel = F.concat(
        F.lit(f'<?xml version="1.0" encoding="UTF-8" ?>\n<rss version="2.0">\n  <channel>\n    <link>{site}</link>\n'), body,
        F.lit("\n  </channel>\n</rss>\n"),
    )
    sinks.write_documents(items.agg(channel.alias("xml")).withColumn("name", F.lit("feed")), f"{out}/feed", "name", "xml")

    extra = pages if pages is not None else spark.createDataFrame([], "url string")
    post_rows = listed.select(F.format_string("%012d", "position").alias("sort_key"), "url")
    sinks.write_site_map(corpus.site_map(post_rows, counts.select("tag", "tag_slug"), extra), site, f"{out}/sitemap")
    return count


def site_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file of a site as its absolute path within it; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    return listed.select(_within(F.col("path"), root).alias("file"))


def _within(path: Column, root: str) -> Column:
    plain = F.regexp_replace(path, r"\Afile:/+", "/")
    return F.regexp_replace(plain, rf"\A.*?\Q{root.rstrip('/')}\E(?=/)", "")


def audit_site(spark: SparkSession, root: str, rules=None, page: str | None = None) -> dict[str, DataFrame]:
    """Findings of a site audit by name, plus ``report``."""
    packs = [rules] if rules else [rx.SYMBOL_ARTIFACTS, rx.BAD_VISIBLE_TEXT, rx.BAD_NOTES]
    every = sources.html_tree(spark, root).select(_within(F.col("path"), root).alias("file"), F.col("raw").alias("html"))
    pages = every.filter(F.col("file") == f"/{page.lstrip('/')}") if page else every
    files = site_files(spark, root)
    # Pages are read once; every check works on the stored row of a page.
    pages_found = materialize(audit.page_findings(pages, "file", "html", packs))
    marked = every.select("file", hx.ids(F.col("html")).alias("ids")) if page else None
    blocks = audit.listings_of(pages_found, ["file"], F.col("listings"))
    broken = audit.integrity(pages_found, files, marked)
    residue, errors = audit.code_residue(blocks, ["file"], keep=None), audit.code_errors(blocks, ["file"])
    leaks = F.posexplode(F.slice("leaks", 1, audit.LEAKS_PER_PAGE)).alias("leak_no", "block")
    found = {
        **broken,
        "rule_hits": pages_found.select("file", F.explode("rule_hits").alias("f")).select("file", "f.rule", "f.matched"),
        "bad_preambles": pages_found.filter("bad_preamble").select("file"),
        "missing_controls": pages_found.filter("missing_controls").select("file"),
        "missing_numbers": pages_found.select("file", F.explode("missing_numbers").alias("number")),
        "running_headers": pages_found.select("file", F.explode("running_headers").alias("text")),
        "nested_code_tabs": pages_found.filter("nested_code_tabs").select("file"),
        "unversioned": pages_found.select("file", F.explode("unversioned").alias("reference")),
        "code_residue": audit.code_residue(blocks, ["file"]),
        "code_errors": errors,
        "language_leaks": pages_found.select("file", leaks).select(
            "file", (F.col("leak_no") + 1).cast("long").alias("leak_no"), F.substring("block", 1, 180).alias("block")
        ),
    }
    counted = {**broken, "code_residue": residue, "code_errors": errors}
    return {**found, "report": audit.findings_report(pages_found, {name: (rows, True) for name, rows in counted.items()})}
