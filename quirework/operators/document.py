"""A page layout put together as one document: listings, figures, headings, paragraphs, contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import code as cx
from quirework.functions import html as hx
from quirework.functions import text as tx
from quirework.operators import layout
from quirework.operators.corpus import newest
from quirework.plans.ordered import RunningSum, ordered_scan

# --- fixed values of the output ---------------------------------------------------
LISTING = (
    '<div class="r-code-card"><div class="code-toolbar"><span>R</span><button class="copy-code" type="button" '
    'data-code-target="%s">复制</button></div><pre><code id="%s" class="language-r">%s</code></pre></div>'
)
FIGURE = '<figure class="book-figure"><img src="%s" alt="%s"><figcaption>%s</figcaption></figure>'
LISTING_ID, ANCHOR, ANCHOR_DIGITS = "r-code-", "section-", 12
LONGEST_HEADING = 180
CONTENTS = 80
# ----------------------------------------------------------------------------------


def listing_card(code: Column, code_id: Column) -> Column:
    """A listing with its copy button."""
    safe = tx.escape_html(code_id)
    return F.format_string(LISTING, safe, safe, tx.escape_html(tx.strip(code)))


def figure(asset: Column, caption: Column) -> Column:
    safe = tx.escape_html(caption)
    return F.format_string(FIGURE, asset, safe, safe)


def document_rows(blocks: DataFrame, answers: DataFrame, assets: DataFrame, page: str, pos: str, bucket: Column) -> DataFrame:
    """Rows (page, pos, kind, html, anchor, text) of a document, in the order of page and pos.

    ``blocks`` are numbered text blocks (``layout.text_block_ids``) with their font ``size``; ``answers(unit_id, tr, latest)``
    their translations, of which the latest counts (without that column, the greatest); ``assets(page, caption, asset, rank)`` the images of captions, of which the last
    counts.  A block without an answer shows its source.  An empty text, and one that turned into a
    listing which the source is not, is left out.  ``bucket`` follows the pages, so the listings of
    the document are numbered without one task walking them all.
    """
    newest = F.col("latest") if "latest" in answers.columns else F.col("tr")
    told = answers.groupBy("unit_id").agg(F.max_by("tr", newest).alias("__tr"))
    drawn = assets.groupBy(page, F.col("caption").alias("src")).agg(F.max_by("asset", "rank").alias("__asset"))
    sized = blocks.withColumn("__size", F.bround("size").cast("int"))
    tiers = layout.heading_tiers(
        sized.filter(~F.col("is_listing") & (F.col("src") != "")), "__size", F.struct(page, pos)
    ).select("__size", "tier")
    numbered = ordered_scan(sized, [], bucket, [page, pos], RunningSum("__code", F.col("is_listing").cast("long")))
    told_rows = numbered.join(told, "unit_id", "left").join(drawn, [page, "src"], "left").join(tiers, "__size", "left")
    rows = told_rows.withColumn("text", tx.strip(F.coalesce("__tr", "src")))
    rows = rows.filter(F.col("is_listing") | ((F.col("text") != "") & ~cx.code_like_lines(F.col("text"))))

    anchor = F.concat(F.lit(ANCHOR), F.substring(tx.sha1_text(F.col("text")), 1, ANCHOR_DIGITS))
    head = F.concat(
        F.lit("<"), F.col("tier"), F.lit(' id="'), anchor, F.lit('">'), tx.escape_html(F.col("text")), F.lit("</"), F.col("tier"), F.lit(">")
    )
    kind = (
        F.when(F.col("is_listing"), "listing")
        .when(F.coalesce("__asset", F.lit("")) != "", "figure")
        .when(F.col("tier").isNotNull() & (F.length("text") <= LONGEST_HEADING), "heading")
        .otherwise("text")
    )
    code_id = F.concat(F.lit(LISTING_ID), F.col("__code").cast("string"))
    made = (
        F.when(kind == "listing", listing_card(F.col("src"), code_id))
        .when(kind == "figure", figure(F.col("__asset"), F.col("text")))
        .when(kind == "heading", head)
        .otherwise(hx.paragraphs(F.col("text")))
    )
    return rows.select(page, pos, kind.alias("kind"), made.alias("html"), F.when(kind == "heading", anchor).alias("anchor"), "text")


def document_contents(rows: DataFrame, page: str, pos: str, count: int = CONTENTS) -> DataFrame:
    """Links (rank, html) to the first ``count`` headings."""
    heads = rows.filter("kind = 'heading'").select(page, pos, "anchor", "text")
    link = F.concat(F.lit('<a href="#'), F.col("anchor"), F.lit('">'), tx.escape_html(F.col("text")), F.lit("</a>"))
    return newest(heads, count, [F.asc(page), F.asc(pos)]).select("rank", link.alias("html"))
