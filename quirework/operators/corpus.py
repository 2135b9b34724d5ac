"""Posts, tags, listings, feed, site map, search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import text as tx
from quirework.plans.ordered import Following, Previous, RowNumber, ordered_scan

# --- fixed values -----------------------------------------------------------------
FEED_ITEMS = 20
HOME_CARDS = 6
HOME_TAGS = 8
FIXED_PAGES = ("/", "/posts/", "/tags/", "/about/")
# ----------------------------------------------------------------------------------


def published(posts: DataFrame) -> DataFrame:
    return posts.filter(~F.col("draft"))


def newest(posts: DataFrame, count: int, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """The first ``count`` rows by ``order``, numbered.  A top-k: each task keeps its best
    ``count`` rows, and only those are merged and numbered."""
    top = posts.orderBy(*order).limit(count)
    numbered = top.agg(F.collect_list(F.struct("*")).alias("__top")).select(F.posexplode("__top").alias("__p", "__row"))
    return numbered.select((F.col("__p") + 1).cast("long").alias(name), *[F.col("__row")[c].alias(c) for c in posts.columns])


def home_bands(posts: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Featured row and the next five."""
    band = F.when(F.col("rank") == 1, F.lit("featured")).otherwise(F.lit("next"))
    return newest(posts, HOME_CARDS, order).withColumn("band", band)


def top_per_group(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int, name: str = "rank") -> DataFrame:
    """First ``count`` rows per key.  The rank filter is pushed below the shuffle, so each
    task sends at most ``count`` rows per key."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(name, place).filter(F.col(name) <= count).withColumn(name, F.col(name).cast("long"))


def post_tags(posts: DataFrame, post: str, tags: Column) -> DataFrame:
    return posts.select(post, F.explode(tags).alias("tag"))


def tag_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("tag").agg(F.count(F.lit(1)).alias("posts")).withColumn("tag_slug", tx.slugify(F.col("tag")))


def tag_pages(tagged: DataFrame, bucket: Column, order: Sequence[str]) -> DataFrame:
    """Rows of each tag's page, numbered in listing order."""
    return ordered_scan(tagged, ["tag"], bucket, order, RowNumber("position"))


def tag_page_owner(tags: DataFrame) -> DataFrame:
    """Tags sharing a slug share a page; the last in sorted order owns it."""
    return tags.groupBy("tag_slug").agg(F.max("tag").alias("tag"), F.count(F.lit(1)).alias("tags_on_slug"))


def neighbours(rows: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str], value: str) -> DataFrame:
    return ordered_scan(rows, keys, bucket, order, Previous("previous", F.col(value)), Following("following", F.col(value)))


def search(rows: DataFrame, title: Column, tags: Column, query: str = "", tag: str = "") -> DataFrame:
    """Substring search over title and tags; the tag filter is a substring test as well."""
    hay = F.concat_ws(" ", F.lower(title), F.lower(tags))
    wanted = [w for w in (query.strip().lower(), tag.lower()) if w]
    return rows.filter(tx.contains_all(hay, wanted)) if wanted else rows


def site_map(posts: DataFrame, tags: DataFrame, pages: DataFrame) -> DataFrame:
    """Addresses in site-map order (section, sort_key): fixed pages, posts, tags, then book
    pages that are not listed yet.

    ``posts`` has (sort_key, url) in listing order, ``tags`` (tag_slug), ``pages`` (url).
    """
    spark = posts.sparkSession
    fixed = spark.createDataFrame([(0, f"{i:020d}", u) for i, u in enumerate(FIXED_PAGES)], "section int, sort_key string, url string")
    post_rows = posts.select(F.lit(1).alias("section"), "sort_key", "url")
    tag_rows = tags.select(F.lit(2).alias("section"), F.col("tag").alias("sort_key"), F.concat(F.lit("/tags/"), "tag_slug", F.lit("/")).alias("url"))
    listed = fixed.unionByName(post_rows).unionByName(tag_rows)
    extra = pages.select("url").distinct().join(listed.select("url"), "url", "left_anti")
    return listed.unionByName(extra.select(F.lit(3).alias("section"), F.col("url").alias("sort_key"), "url"))


def feed(posts: DataFrame, site: str, order: Sequence[Column]) -> DataFrame:
    """The newest items (title, date, summary, slug) as feed entries."""
    link = F.concat(F.lit(site), F.lit("/posts/"), F.col("slug"), F.lit("/"))
    item = F.concat(
        F.lit("    <item>\n      <title>"), tx.escape_xml(F.col("title")),
        F.lit("</title>\n      <link>"), link, F.lit("</link>\n      <guid>"), link,
        F.lit("</guid>\n      <pubDate>"), tx.feed_date(F.col("date")),
        F.lit("</pubDate>\n      <description>"), tx.escape_xml(F.col("summary")), F.lit("</description>\n    </item>"),
    )
    return newest(posts, FEED_ITEMS, order).select("rank", link.alias("link"), item.alias("item"))


def table_of_contents(rows: DataFrame, keys: Sequence[str], order: str, entry: Column, separator: str = "\n") -> DataFrame:
    """Entries of a (naturally small) group in order, as one text."""
    packed = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), entry.alias("e"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(packed, lambda s: s["e"]), separator).alias("toc"))
