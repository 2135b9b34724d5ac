"""Book queries: orders as units, their lines as pages and sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.catalog.registry import query, replaces
from quirework.operators import audit, book, refresh
from quirework.plans.ordered import id_bucket
from quirework.session import materialize
from quirework.sources.tables import table

ROOT = "book"

_PARTS = """WITH u AS (SELECT o_orderkey % 7 AS book, o_orderkey, 'unit-' || o_orderkey AS slug, o_orderpriority || ' &amp; ' || o_orderkey AS title,
      o_orderkey * 10 + 1 AS first_page, o_orderkey * 10 + 7 AS last_page FROM orders),
    p AS (SELECT l_orderkey * 10 + l_linenumber AS page, min(l_partkey) AS v FROM lineitem WHERE l_quantity > 10 GROUP BY 1),
    s AS (SELECT DISTINCT l_orderkey, l_orderkey * 10 + l_linenumber AS page, l_partkey AS v FROM lineitem WHERE l_returnflag = 'R'),
    n AS (SELECT *, lag('<a href="/book/' || slug || '/">上一节：' || title || '</a>') OVER w AS before,
        lead('<a href="/book/' || slug || '/">下一节：' || title || '</a>') OVER w AS after FROM u WINDOW w AS (PARTITION BY book ORDER BY o_orderkey)),
    e AS (SELECT book, slug, o_orderkey, unnest(range(first_page, last_page + 1)) AS page FROM u),
    parts AS (
      SELECT book, slug, 0 AS part, NULL::BIGINT AS page, 0 AS layer, NULL::BIGINT AS rank, '<h1>' || title || '</h1>' AS html FROM u
      UNION ALL SELECT book, slug, 1, page, 1, NULL, '<p id="p' || v || '">' || v || '</p>' FROM e LEFT JOIN p USING (page)
      UNION ALL SELECT book, slug, 1, e.page, 0, s.v, '<span class="section-anchor" id="p' || s.v || '"></span>'
        FROM e JOIN s ON s.l_orderkey = e.o_orderkey AND s.page = e.page JOIN p ON p.page = e.page WHERE s.v <> p.v
      UNION ALL SELECT book, slug, 2, NULL, 0, NULL, '<nav class="chapter-nav">' || coalesce(before, '<span></span>') || coalesce(after, '') || '</nav>' FROM n)
    """


def _units(spark, folder):
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderpriority", spread="o_orderkey")
    key = F.col("o_orderkey").cast("long")
    return orders.select(
        (key % 7).alias("book"), "o_orderkey", F.concat(F.lit("unit-"), key.cast("string")).alias("slug"),
        F.concat("o_orderpriority", F.lit(" & "), key.cast("string")).alias("title"),
        (key * 10 + 1).alias("first_page"), (key * 10 + 7).alias("last_page"),
    )


def _parts(spark, folder):
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    lines = lines.select("*", (F.col("l_orderkey") % 7).cast("long").alias("book"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("page"))
    made = lines.filter("l_quantity > 10").groupBy("book", "page").agg(F.min("l_partkey").cast("string").alias("v"))
    pages = made.select("book", "page", F.concat(F.lit('<p id="p'), "v", F.lit('">'), "v", F.lit("</p>")).alias("html"))
    sections = lines.filter("l_returnflag = 'R'").select(
        "book", F.concat(F.lit("unit-"), F.col("l_orderkey").cast("string")).alias("unit"), "page",
        F.col("l_partkey").cast("long").alias("rank"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("slug"),
    ).distinct()
    return book.unit_parts(_units(spark, folder), pages, sections, ["book"], "o_orderkey", id_bucket("o_orderkey"), ROOT)


@query(_PARTS + "SELECT * FROM parts")
def unit_pages(spark, folder):
    """Heading, anchors, pages and neighbour links of every unit, as ordered rows."""
    return _parts(spark, folder)


@query(_PARTS + "SELECT book, slug, page FROM parts WHERE part = 1 AND layer = 1 AND html IS NULL")
def unit_missing_pages(spark, folder):
    """Expected pages of the units that are not there."""
    return book.missing_pages(_parts(spark, folder), ["book"])


@query(
    """SELECT o_orderkey % 7 AS book, o_orderkey, 'unit-' || o_orderkey AS slug,
       '<li><a href="/book/unit-' || o_orderkey || '/">' || o_orderpriority || ' &amp; ' || o_orderkey || '</a></li>' AS html FROM orders"""
)
def unit_contents(spark, folder):
    """Contents list of every book."""
    return book.contents(_units(spark, folder), ["book"], "o_orderkey", ROOT)


_LED = """WITH s AS (SELECT c_custkey AS unit, 'Topic of ' || c_name AS title, CASE WHEN c_custkey % 4 = 0 THEN b ELSE a END AS section_page
      FROM customer JOIN (SELECT o_custkey, min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders GROUP BY 1) ON o_custkey = c_custkey),
    p AS (SELECT o_custkey AS unit, o_orderkey AS page, title, section_page, o_orderkey % 5 = 0 AS other, o_orderkey % 3 AS kind,
        '<section class="book-page" data-pdf-page="' || o_orderkey || '">' AS opening, '<h2 id="section-' || o_custkey || '">' || title || '</h2>' AS heading
      FROM orders JOIN s ON s.unit = o_custkey)"""


def _led(spark, folder):
    """Pages led by the title of their unit's section, the sections, and the source of the pages."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer", "c_custkey", "c_name").select(F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("Topic of "), "c_name").alias("title"))
    first = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("a"), F.max("o_orderkey").alias("b")).join(customers, "o_custkey")
    page = F.when(F.col("o_custkey") % 4 == 0, F.col("b")).otherwise(F.col("a"))
    sections = first.select(
        F.col("o_custkey").alias("unit"), F.concat(F.lit("section-"), F.col("o_custkey").cast("string")).alias("slug"), F.col("title").alias("title_en"),
        F.lit(None).cast("string").alias("title_zh"), F.lit(1).alias("level"), page.alias("pdf_page"),
    )
    rows = orders.join(customers, "o_custkey")
    number, kind = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 3
    head = F.when(F.col("o_orderkey") % 5 == 0, "<p>Elsewhere</p>").otherwise(F.concat(F.lit("<h2>"), F.upper("title"), F.lit("</h2>")))
    pages = rows.select(
        F.col("o_custkey").alias("unit"), F.col("o_orderkey").alias("page"),
        F.concat(F.lit('<section class="book-page" data-pdf-page="'), number, F.lit('">'), head, F.lit("<p>One</p><figure>f</figure><p>Two</p></section>")).alias("html"),
    )
    before = F.when(kind == 0, "").when(kind == 1, "This is a line of running text.\n").otherwise("Fig. 3.1. Something is shown here.\n")
    sources = rows.select(
        F.col("o_custkey").alias("unit"), F.col("o_orderkey").alias("page"), F.concat(before, "title", F.lit("\nMore text follows on this page.")).alias("text")
    )
    return pages, sections, sources


@query(
    _LED
    + """ SELECT unit, page, opening || CASE WHEN other THEN '<p>Elsewhere</p><p>One</p><figure>f</figure><p>Two</p>'
      WHEN section_page > page OR (section_page = page AND kind = 0) THEN '<h2>' || upper(title) || '</h2><p>One</p><figure>f</figure><p>Two</p>'
      WHEN section_page < page THEN '<p>One</p><figure>f</figure><p>Two</p>'
      WHEN kind = 1 THEN '<p>One</p><figure>f</figure>' || heading || chr(10) || '<p>Two</p>'
      ELSE '<p>One</p><figure>f</figure>' || chr(10) || heading || '<p>Two</p>' END || '</section>' AS html FROM p"""
)
def heading_repair(spark, folder):
    """Pages with the section titles at their head removed or moved to where the source has them."""
    pages, sections, sources = _led(spark, folder)
    return book.repair_headings(pages, sections, sources, ["unit"])


@query(_LED + " SELECT unit, page, 'section-' || unit AS slug FROM p WHERE NOT other AND (section_page < page OR (section_page = page AND kind > 0))")
def misplaced_headings(spark, folder):
    """Titles at the head of a page whose section began earlier, or begins further down."""
    pages, sections, sources = _led(spark, folder)
    found = audit.misplaced_headings(pages.select("unit", F.col("html")), sections, ["unit"], "html", sources)
    return found.select("unit", "page", F.col("section_slug").alias("slug"))


#: Characters of a text in the earlier state of the books, and of a title.
OLD_LENGTH, TITLE_LENGTH = 2_000, 40
_ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]


def _rendered(rows: str) -> str:
    entry = lambda doc, title, label="": f"""'<a href="/book/doc-' || {doc} || '/">{label}' || {replaces(title, _ESCAPES)} || '</a>'"""
    return f"""SELECT source, doc_id, '<h1>' || {replaces('title', _ESCAPES)} || '</h1>' || body
        || CASE WHEN first < doc_id THEN '<ul class="references"><li>' || {entry('first', 'title')} || '</li></ul>' ELSE '' END
        || '<nav class="chapter-nav">' || coalesce({entry('b', 'b_title', '上一节：')}, '<span></span>') || coalesce({entry('a', 'a_title', '下一节：')}, '') || '</nav>' AS html
      FROM (SELECT *, min(doc_id) OVER (PARTITION BY source, body) AS first, lag(doc_id) OVER w AS b, lag(title) OVER w AS b_title,
        lead(doc_id) OVER w AS a, lead(title) OVER w AS a_title FROM {rows} WINDOW w AS (PARTITION BY source ORDER BY doc_id))"""


@query(
    f"""WITH new_rows AS (SELECT source, doc_id, text AS body, left(text, {TITLE_LENGTH}) AS title FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
    old_rows AS (SELECT source, doc_id, left(text, {OLD_LENGTH}) AS body, left(text, {TITLE_LENGTH}) AS title FROM documents
      WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)),
    n AS ({_rendered('new_rows')}), o AS ({_rendered('old_rows')})
    SELECT source, 'doc-' || doc_id AS slug, CASE WHEN n.html IS NULL THEN 'removed' WHEN o.html IS NULL THEN 'added' WHEN n.html = o.html THEN 'same' ELSE 'changed' END AS state,
      sha1(n.html) AS html_sha1, n.html IS NOT NULL AND n.html IS DISTINCT FROM o.html AS rendered
    FROM n FULL JOIN o USING (source, doc_id)"""
)
def refresh_delta(spark, folder):
    """A book of documents per source after texts grew, toxic ones went and bad ones came: what is rendered anew,
    and that it gives, with what is kept, the pages of a full rendering.  A copy refers to its first."""
    labels = table(spark, folder, "labels", "doc_id", "quality", "toxic")
    docs = table(spark, folder, "documents", "doc_id", "source", "text", spread="doc_id")

    def state(gone, body):
        rows = docs.join(labels.filter(gone).select("doc_id"), "doc_id", "left_anti")
        slug = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
        pages = rows.select("source", "doc_id", slug.alias("slug"), F.substring("text", 1, TITLE_LENGTH).alias("title"), body.alias("body"))
        # Digests of the texts travel to find copies.
        known = materialize(pages.select("source", "doc_id", "slug", F.sha2("body", 256).alias("copy")))
        first = known.groupBy("source", "copy").agg(F.min_by("slug", "doc_id").alias("target"))
        copies = known.join(first, ["source", "copy"]).filter(F.col("slug") != F.col("target"))
        return pages, copies.select("source", "slug", "target")

    def delta(rows, stored):
        return refresh.delta(*rows, stored, ["source"], "doc_id", id_bucket("doc_id"), "1", lambda: refresh.unit_page(ROOT))

    old = delta(state("quality = 0", F.substring("text", 1, OLD_LENGTH)), None)
    stored = materialize(old.select("source", *refresh.STORED, "html"))
    found = materialize(delta(state("toxic = 1", F.col("text")), stored.drop("html")))
    pages = refresh.refreshed(found, stored, ["source"]).select("source", "slug", F.sha1("html").alias("html_sha1"))
    states = found.select("source", "slug", "state", F.col("html").isNotNull().alias("rendered"))
    return states.join(pages, ["source", "slug"], "left")
