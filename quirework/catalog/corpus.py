"""Listing, tag, search, lookup and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.catalog.registry import hrefs, q, query, slug
from quirework.functions import html as hx
from quirework.functions import paths as px
from quirework.functions import rules as rx
from quirework.functions import text as tx
from quirework.operators import audit, corpus, units
from quirework.plans.ordered import GroupMax, RowNumber, id_bucket, ordered_scan
from quirework.session import materialize
from quirework.sources.tables import table


def _docs(spark, folder, *columns):
    return table(spark, folder, "documents", *columns)


@query(
    """SELECT md5(text) AS digest, min(doc_id) AS doc_id, count(*)::BIGINT AS copies FROM documents GROUP BY md5(text)"""
)
def doc_exact_dedup(spark, folder):
    """First document of each distinct text.  A partial aggregate, so a text with very many
    copies costs one row per task."""
    docs = _docs(spark, folder, "doc_id", "text").select("doc_id", F.md5("text").alias("digest"))
    return docs.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


@query(
    """SELECT doc_id, first_value(doc_id) OVER (PARTITION BY md5(text) ORDER BY doc_id) AS kept_id,
       row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id)::BIGINT AS copy_no FROM documents"""
)
def doc_copies(spark, folder):
    """Every document with the copy that is kept; all placements stay."""
    docs = materialize(_docs(spark, folder, "doc_id", "text").select("doc_id", F.md5("text").alias("digest")))
    numbered = ordered_scan(
        docs, ["digest"], id_bucket("doc_id"), ["doc_id"], RowNumber("copy_no"), GroupMax("__kept", -F.col("doc_id"))
    )
    return numbered.select("doc_id", (-F.col("__kept")).alias("kept_id"), "copy_no")


@query("SELECT source, count(*)::BIGINT AS docs, sum(length(text))::BIGINT AS chars FROM documents GROUP BY source")
def doc_source_counts(spark, folder):
    docs = _docs(spark, folder, "source", "text")
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.length("text")).cast("long").alias("chars"))


@query("SELECT lang, count(*)::BIGINT AS docs, count(DISTINCT source)::BIGINT AS sources FROM documents GROUP BY lang")
def doc_lang_counts(spark, folder):
    per_source = _docs(spark, folder, "lang", "source").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    return per_source.groupBy("lang").agg(F.sum("n").alias("docs"), F.count(F.lit(1)).alias("sources"))


_TAGGED = "SELECT doc_id, unnest([lang, source]) AS tag FROM documents"


def _tagged(spark, folder):
    return corpus.post_tags(_docs(spark, folder, "doc_id", "lang", "source"), "doc_id", F.array("lang", "source"))


@query(f"SELECT tag, count(*)::BIGINT AS posts, {slug('tag')} AS tag_slug FROM ({_TAGGED}) GROUP BY tag")
def doc_tag_counts(spark, folder):
    return corpus.tag_counts(_tagged(spark, folder))


@query(f"SELECT tag, doc_id, row_number() OVER (PARTITION BY tag ORDER BY doc_id DESC)::BIGINT AS position FROM ({_TAGGED})")
def doc_tag_pages(spark, folder):
    """Listing of every tag page, newest first, each row with its position."""
    tagged = _tagged(spark, folder).withColumn("newest", -F.col("doc_id"))
    return corpus.tag_pages(tagged, id_bucket("newest"), ["newest"]).select("tag", "doc_id", "position")


@query(
    f"""SELECT tag_slug, max(tag) AS tag, count(*)::BIGINT AS tags_on_slug FROM
    (SELECT {slug('tag')} AS tag_slug, tag FROM (SELECT DISTINCT p_type || CASE WHEN p_size % 2 = 0 THEN ' ' ELSE '-' END || p_brand AS tag FROM part)) GROUP BY tag_slug"""
)
def part_tag_owner(spark, folder):
    """Tags whose slugs collide share a page that the last one owns."""
    parts = table(spark, folder, "part", "p_type", "p_size", "p_brand")
    gap = F.when(F.col("p_size") % 2 == 0, F.lit(" ")).otherwise(F.lit("-"))
    tags = parts.select(F.concat("p_type", gap, "p_brand").alias("tag")).distinct()
    return corpus.tag_page_owner(tags.withColumn("tag_slug", tx.slugify(F.col("tag"))))


@query(
    """SELECT row_number() OVER (ORDER BY length(text) DESC, doc_id)::BIGINT AS rank, doc_id, length(text)::BIGINT AS chars
       FROM documents ORDER BY length(text) DESC, doc_id LIMIT 20"""
)
def doc_top20_feed(spark, folder):
    docs = _docs(spark, folder, "doc_id", "text").select("doc_id", F.length("text").cast("long").alias("chars"))
    return corpus.newest(docs, corpus.FEED_ITEMS, [F.desc("chars"), F.asc("doc_id")])


@query(
    """WITH t AS (SELECT o_orderkey, o_orderpriority, o_orderdate, row_number() OVER (ORDER BY strftime(o_orderdate, '%Y-%m-%d') DESC, o_orderkey) AS r FROM orders)
    SELECT r::BIGINT AS rank, 'https://example.org/posts/order-' || o_orderkey || '/' AS link,
      '    <item>' || chr(10) || '      <title>' || o_orderpriority || ' &amp; more</title>' || chr(10) ||
      '      <link>https://example.org/posts/order-' || o_orderkey || '/</link>' || chr(10) ||
      '      <guid>https://example.org/posts/order-' || o_orderkey || '/</guid>' || chr(10) ||
      '      <pubDate>' || strftime(o_orderdate, '%a, %d %b %Y') || ' 00:00:00 +0800</pubDate>' || chr(10) ||
      '      <description>' || o_orderkey || ' &lt;x&gt;</description>' || chr(10) || '    </item>' AS item
    FROM t WHERE r <= 20"""
)
def order_feed(spark, folder):
    """Feed entries of the twenty newest orders; equal dates keep their key order."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderpriority", "o_orderdate")
    posts = orders.select(
        "o_orderkey",
        F.concat("o_orderpriority", F.lit(" & more")).alias("title"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(" <x>")).alias("summary"),
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("slug"),
    )
    return corpus.feed(posts, "https://example.org", [F.desc("date"), F.asc("o_orderkey")])


@query(
    """WITH t AS (SELECT doc_id, source, row_number() OVER (ORDER BY length(text) DESC, doc_id) AS r FROM documents)
    SELECT r::BIGINT AS rank, doc_id, source, CASE WHEN r = 1 THEN 'featured' ELSE 'next' END AS band FROM t WHERE r <= 6"""
)
def doc_featured_and_next5(spark, folder):
    docs = _docs(spark, folder, "doc_id", "source", "text").select("doc_id", "source", F.length("text").alias("chars"))
    bands = corpus.home_bands(docs, [F.desc("chars"), F.asc("doc_id")])
    return bands.select("rank", "doc_id", "source", "band")


@query(
    """SELECT doc_id, source, lag(doc_id) OVER w AS previous, lead(doc_id) OVER w AS following FROM documents
       WINDOW w AS (PARTITION BY source ORDER BY doc_id)"""
)
def doc_neighbours(spark, folder):
    docs = _docs(spark, folder, "doc_id", "source")
    return corpus.neighbours(docs, ["source"], id_bucket("doc_id"), ["doc_id"], "doc_id")


@query(
    """SELECT doc_id, source FROM documents WHERE contains(lower(text) || ' ' || lower(lang || ' ' || source), 'tion')
       AND contains(lower(text) || ' ' || lower(lang || ' ' || source), 'src1')"""
)
def doc_search(spark, folder):
    """Search over the whole text and the tags; the tag test is a substring test too."""
    docs = _docs(spark, folder, "doc_id", "text", "lang", "source")
    hits = corpus.search(docs, F.col("text"), F.concat_ws(" ", "lang", "source"), " TION ", "src1")
    return hits.select("doc_id", "source")


@query(
    f"""WITH fixed AS (SELECT 0 AS section, lpad((generate_subscripts(l, 1) - 1)::VARCHAR, 20, '0') AS sort_key, unnest(l) AS url FROM (SELECT ['/', '/posts/', '/tags/', '/about/'] AS l)),
    posts AS (SELECT 1, lpad(doc_id::VARCHAR, 20, '0'), '/posts/doc-' || doc_id || '/' FROM documents),
    tags AS (SELECT DISTINCT 2, tag, '/tags/' || {slug('tag')} || '/' FROM (SELECT unnest([lang, source]) AS tag FROM documents UNION ALL SELECT n_name FROM nation)),
    listed AS (FROM fixed UNION ALL FROM posts UNION ALL FROM tags),
    links AS (SELECT DISTINCT CASE WHEN page_id % 3 = 0 THEN '/posts/doc-' || page_id || '/' ELSE href END AS url FROM (SELECT page_id, unnest({hrefs('html')}) AS href FROM pages))
    FROM listed UNION ALL SELECT 3, url, url FROM links WHERE url NOT IN (SELECT url FROM listed)"""
)
def site_url_union(spark, folder):
    """Site map: fixed pages, posts, tags, then linked pages that are not listed yet."""
    docs = _docs(spark, folder, "doc_id", "lang", "source")
    key = F.col("doc_id").cast("string")
    posts = docs.select(F.lpad(key, 20, "0").alias("sort_key"), F.concat(F.lit("/posts/doc-"), key, F.lit("/")).alias("url"))
    tags = docs.select(F.explode(F.array("lang", "source")).alias("tag")).unionByName(
        table(spark, folder, "nation", "n_name").select(F.col("n_name").alias("tag"))
    )
    tags = tags.distinct().withColumn("tag_slug", tx.slugify(F.col("tag")))
    pages = table(spark, folder, "pages", "page_id", "html").select("page_id", F.explode(hx.links(F.col("html"))).alias("href"))
    page = F.concat(F.lit("/posts/doc-"), F.col("page_id").cast("string"), F.lit("/"))
    urls = pages.select(F.when(F.col("page_id") % 3 == 0, page).otherwise(F.col("href")).alias("url"))
    return corpus.site_map(posts, tags, urls)


@query(
    """SELECT c_custkey, coalesce(nullif(CASE WHEN n_nationkey % 3 = 0 THEN n_name END, ''), CASE WHEN r_regionkey < 3 THEN r_name END,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Building' WHEN 'MACHINERY' THEN 'Machinery' END, c_name) AS title
       FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey"""
)
def title_lookup_coalesce(spark, folder):
    """Title of each customer by a chain of lookups, the raw name last."""
    customers = table(spark, folder, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_regionkey", F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name")).alias("by_nation")
    )
    regions = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.when(F.col("r_regionkey") < 3, F.col("r_name")).alias("by_region")
    )
    found = customers.join(nations, "c_nationkey", "left").join(regions, "n_regionkey", "left")
    fixed = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Building")).when(F.col("c_mktsegment") == "MACHINERY", F.lit("Machinery"))
    title = units.first_known([F.col("by_nation"), F.col("by_region"), fixed], F.col("c_name"))
    return found.select("c_custkey", title.alias("title"))


@query(
    """SELECT key, arg_min(title, p) AS title FROM (
       SELECT lower(n_name) AS key, n_name AS title, 0 AS p FROM nation UNION ALL SELECT lower(r_name), 'region ' || r_name, 1 FROM region
       UNION ALL SELECT DISTINCT lower(p_type), 'type ' || p_type, 2 FROM part) GROUP BY key"""
)
def title_map_merge(spark, folder):
    """Title maps merged; the first map that knows a key wins."""
    def mapped(name, column, label):
        return table(spark, folder, name, column).distinct().select(F.lower(column).alias("key"), F.concat(F.lit(label), column).alias("title"))

    maps = [mapped("nation", "n_name", ""), mapped("region", "r_name", "region "), mapped("part", "p_type", "type ")]
    return units.merge_title_maps(maps, "key", "title")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def label_missing_docs(spark, folder):
    return _docs(spark, folder, "doc_id").join(table(spark, folder, "labels", "doc_id"), "doc_id", "left_anti")


@query("SELECT doc_id, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1)")
def label_semi_docs(spark, folder):
    good = table(spark, folder, "labels", "doc_id", "quality").filter("quality = 1")
    return _docs(spark, folder, "doc_id", "source").join(good, "doc_id", "left_semi")


@query(
    f"""WITH m AS (SELECT
      (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS missing_labels,
      (SELECT count(*) FROM labels WHERE toxic = 1) AS toxic_docs,
      (SELECT count(*) FROM documents WHERE {' OR '.join(f'contains(text, {q(r.pattern)})' for r in rx.BAD_VISIBLE_TEXT)}) AS bad_visible,
      (SELECT count(*) FROM (SELECT unnest({hrefs('html')}) FROM pages)) AS links,
      (SELECT count(*) FROM pages WHERE NOT regexp_matches(html, '(?i)^<!doctype html>')) AS bad_preambles)
    SELECT missing_labels::BIGINT AS missing_labels, toxic_docs::BIGINT AS toxic_docs, bad_visible::BIGINT AS bad_visible, links::BIGINT AS links,
      bad_preambles::BIGINT AS bad_preambles, CASE WHEN missing_labels + bad_visible + bad_preambles > 0 THEN 'incomplete' ELSE 'ready' END AS status FROM m"""
)
def quality_report(spark, folder):
    """One-row report; hard metrics decide the status, soft ones are only shown."""
    labels = table(spark, folder, "labels", "doc_id", "toxic")
    pages = table(spark, folder, "pages", "page_id", "html")
    judged = _docs(spark, folder, "doc_id", "text").select("doc_id", rx.hits_any(F.col("text"), rx.BAD_VISIBLE_TEXT).alias("bad"))
    known = labels.select("doc_id").distinct().withColumn("labelled", F.lit(True))
    return audit.report(
        [
            (
                judged.join(known, "doc_id", "left"),
                {"missing_labels": (F.count_if(F.col("labelled").isNull()), True), "bad_visible": (F.count_if("bad"), True)},
            ),
            (labels, {"toxic_docs": (F.count_if(F.col("toxic") == 1), False)}),
            (
                pages,
                {
                    "links": (F.sum(F.size(hx.links(F.col("html")))), False),
                    "bad_preambles": (F.count_if(~F.col("html").rlike(r"(?i)\A<!doctype html>")), True),
                },
            ),
        ]
    )


@query(
    """WITH r AS (SELECT count(*)::BIGINT AS documents, sum(len(string_split(html, '<li>')) - 1)::BIGINT AS list_items,
       sum(len(string_split(html, 'class="r-code-card"')) - 1)::BIGINT AS code_cards, sum(len(string_split(html, 'class="copy-code"')) - 1)::BIGINT AS copy_buttons,
       sum(len(regexp_extract_all(regexp_replace(html, 'data:image/[^"'']+', 'data:image/removed', 'g'), '(?i)TODO|待翻译|未翻译')))::BIGINT AS todo_markers,
       sum(len(string_split(html, 'track(')) - 1)::BIGINT AS red_flags, (SELECT count(*) FROM pages WHERE page_id NOT IN (SELECT doc_id FROM labels))::BIGINT AS missing_answers FROM pages)
    SELECT *, CASE WHEN documents > 0 AND missing_answers = 0 AND code_cards = copy_buttons AND todo_markers = 0 AND red_flags = 0 THEN 'ready' ELSE 'fail' END AS status FROM r"""
)
def page_document_report(spark, folder):
    """Document report with red flags; labels stand for the answers that came back."""
    pages = table(spark, folder, "pages", "page_id", "html")
    done = table(spark, folder, "labels", "doc_id").withColumnRenamed("doc_id", "page_id")
    row = audit.document_report(pages, F.col("html"), pages, done, "page_id", ["track("])
    items = pages.agg(F.sum(tx.count_matches(F.col("html"), "<li>"))).scalar()
    return row.withColumn("list_items", items)


@query(
    """SELECT l_returnflag, rank::BIGINT AS rank, l_extendedprice FROM (SELECT l_returnflag, l_extendedprice,
       row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank FROM lineitem) WHERE rank <= 5"""
)
def per_group_top5(spark, folder):
    """Five dearest lines per flag, three hot groups."""
    lines = table(spark, folder, "lineitem", "l_returnflag", "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey")
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    return corpus.top_per_group(lines, ["l_returnflag"], order, 5).select("l_returnflag", "rank", "l_extendedprice")


@query(
    """SELECT r_name, string_agg('- ' || n_name, chr(10) ORDER BY n_nationkey) AS toc FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY r_name"""
)
def string_toc(spark, folder):
    """Ordered contents of each region as one text (a fixed, small table)."""
    rows = table(spark, folder, "nation").join(
        table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
    )
    return corpus.table_of_contents(rows, ["r_name"], "n_nationkey", F.concat(F.lit("- "), F.col("n_name")))


@query(
    """WITH e AS (SELECT page_id, url FROM pages), k AS (
      SELECT page_id, '/' || regexp_replace(trim(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*', ''), '/'), '\\.html$', '') AS path FROM e)
    SELECT path, min(page_id) AS first_page, count(*)::BIGINT AS pages FROM k WHERE regexp_matches(path, '^/en/[0-9]+$') GROUP BY path"""
)
def page_crawl_list(spark, folder):
    """Allowed paths of the crawl, first occurrence kept."""
    pages = table(spark, folder, "pages", "page_id", "url")
    paths = pages.withColumn("path", px.normalize_path(F.col("url"), lambda h: F.lit(True))).filter(F.col("path").rlike(r"\A/en/[0-9]+\z"))
    return paths.groupBy("path").agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("pages"))
