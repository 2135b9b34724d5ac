"""A document put together from a layout of events: pages are users, blocks are their events."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.catalog.registry import query
from quirework.operators import document, layout
from quirework.plans.ordered import id_bucket
from quirework.session import materialize
from quirework.sources.tables import table

_ESC = "replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"

_ROWS = f"""WITH b AS (SELECT user_id AS page, event_id AS pos, event_type = 'error' AS listing, (event_id * 13) % 300 AS y0,
      CASE WHEN event_type = 'click' THEN '12 Running header' WHEN event_type = 'error' THEN '> x <- ' || event_id || ' & "y"'
        WHEN event_type = 'signup' THEN 'Figure ' || event_id % 100 || '. Caption' WHEN event_id % 26 = 0 THEN 'Title ' || event_id || repeat(' long', 40)
        ELSE 'Text <' || event_id || '>' END AS src,
      CASE WHEN event_id % 11 = 0 THEN 20 WHEN event_id % 13 = 0 THEN 16 WHEN event_id % 17 = 0 THEN 14 ELSE 10 END AS size,
      CASE WHEN event_id % 5 = 0 THEN 'Answer "' || event_id || '"' WHEN event_id % 5 = 1 THEN '' WHEN event_id % 5 = 2 THEN '> drift <- 1' END AS tr FROM events),
    k AS (SELECT * FROM b WHERE NOT (y0 <= 78 AND regexp_matches(src, '^[0-9]+ [^ ].+$'))),
    n AS (SELECT *, sum(listing::INT) OVER (ORDER BY page, pos) AS code FROM k),
    c AS (SELECT size, count(*) AS uses, min((page, pos)) AS first FROM k WHERE NOT listing GROUP BY size),
    h AS (SELECT size, 'h' || least(dense_rank() OVER (ORDER BY size DESC), 3) AS tier FROM c WHERE size > (SELECT size FROM c ORDER BY uses DESC, first LIMIT 1)),
    w AS (SELECT page, pos, listing, code, tier, CASE WHEN listing THEN src ELSE coalesce(tr, src) END AS t,
        NOT listing AND starts_with(src, 'Figure') AND (page % 2 = 0) AND src IN (SELECT 'Figure ' || n_nationkey || '. Caption' FROM nation) AS drawn, src, tr FROM n LEFT JOIN h USING (size)),
    v AS (SELECT *, CASE WHEN listing THEN 'listing' WHEN drawn THEN 'figure' WHEN tier IS NOT NULL AND length(t) <= 180 THEN 'heading' ELSE 'text' END AS kind,
        'section-' || left(sha1(t), 12) AS anchor FROM w WHERE listing OR NOT (t = '' OR starts_with(t, '>'))),
    d AS (SELECT page, pos, kind, anchor, t, CASE kind WHEN 'listing' THEN '<div class="r-code-card"><div class="code-toolbar"><span>R</span><button class="copy-code" type="button" data-code-target="r-code-' || code
          || '">复制</button></div><pre><code id="r-code-' || code || '" class="language-r">' || {_ESC} || '</code></pre></div>'
        WHEN 'figure' THEN '<figure class="book-figure"><img src="/img/' || regexp_extract(src, '[0-9]+') || '.png" alt="' || {_ESC} || '"><figcaption>' || {_ESC} || '</figcaption></figure>'
        WHEN 'heading' THEN '<' || tier || ' id="' || anchor || '">' || {_ESC} || '</' || tier || '>' ELSE '<p>' || {_ESC} || '</p>' END AS html FROM v)
    """


def _rows(spark, folder):
    events = table(spark, folder, "events", "event_id", "user_id", "event_type")
    key, kind, name = F.col("event_id"), F.col("event_type"), F.col("event_id").cast("string")
    text = (
        F.when(kind == "click", F.lit("12 Running header"))
        .when(kind == "error", F.concat(F.lit("> x <- "), name, F.lit(' & "y"')))
        .when(kind == "signup", F.concat(F.lit("Figure "), (key % 100).cast("string"), F.lit(". Caption")))
        .when(key % 26 == 0, F.concat(F.lit("Title "), name, F.repeat(F.lit(" long"), 40)))
        .otherwise(F.concat(F.lit("Text <"), name, F.lit(">")))
    )
    size = F.when(key % 11 == 0, 20.4).when(key % 13 == 0, 16.0).when(key % 17 == 0, 13.8).otherwise(10.0)
    blocks = events.select(
        F.col("user_id").alias("page"), key.alias("pos"), F.lit("text").alias("type"), ((key * 13) % 300).alias("y0"), text.alias("text"), size.alias("size")
    )
    numbered = materialize(layout.text_block_ids(blocks, ["page"], "pos", "page"))
    place = F.col("pos") % 5
    told = F.when(place == 0, F.concat(F.lit('Answer "'), F.col("pos").cast("string"), F.lit('"'))).when(place == 1, "").otherwise("> drift <- 1")
    answers = numbered.filter(place < 3).select("unit_id", told.alias("tr"))
    nations = table(spark, folder, "nation", "n_nationkey").select(F.col("n_nationkey").cast("string").alias("n"))
    pages = numbered.filter("page % 2 = 0").select("page").distinct()
    captions = nations.select(F.concat(F.lit("Figure "), "n", F.lit(". Caption")).alias("caption"), F.concat(F.lit("/img/"), "n", F.lit(".png")).alias("asset"))
    # Captions in even pages have an image; a first, empty one is overridden.
    wanted = numbered.filter(F.col("src").startswith("Figure")).select("page", F.col("src").alias("caption")).distinct()
    found = wanted.join(pages, "page").join(captions, "caption")
    assets = found.select("page", "caption", "asset", F.lit(2).alias("rank")).unionByName(found.select("page", "caption", F.lit("").alias("asset"), F.lit(1).alias("rank")))
    return document.document_rows(numbered, answers, assets, "page", "pos", id_bucket("page", 100))


@query(_ROWS + "SELECT page, pos, kind, html FROM d")
def layout_document(spark, folder):
    """Listings, figures, headings and paragraphs of the document in order."""
    return _rows(spark, folder).select("page", "pos", "kind", "html")


@query(
    _ROWS
    + f"""SELECT rank, '<a href="#' || anchor || '">' || {_ESC} || '</a>' AS html FROM (SELECT *, row_number() OVER (ORDER BY page, pos) AS rank FROM d WHERE kind = 'heading') WHERE rank <= 80"""
)
def layout_contents(spark, folder):
    """Links to the first eighty headings."""
    return document.document_contents(_rows(spark, folder), "page", "pos")
