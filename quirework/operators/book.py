"""A book rendered from its units: the parts of every unit page in order, and the contents list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import fragments as fr
from quirework.functions import html as hx
from quirework.functions import text as tx
from quirework.operators.units import expand, match_headings
from quirework.plans.ordered import Following, Previous, ordered_scan, same_keys

#: Fixed values of the output.
NAV_OPEN, NAV_CLOSE, NO_PREVIOUS = '<nav class="chapter-nav">', "</nav>", "<span></span>"
PREVIOUS_LABEL, NEXT_LABEL = "上一节：", "下一节："
#: Fixed value: a figure or table named in source text.
FIGURE_OR_TABLE = r"\b(?:Fig\.|Figure|Table)\s+[0-9]"

#: Parts of a unit page, in order; a page has its missing section anchors in front.
HEAD, PAGES, NAVIGATION = 0, 1, 2
ANCHOR, FRAGMENT = 0, 1


def unit_path(root: str, slug: Column) -> Column:
    return F.concat(F.lit(f"/{root.strip('/')}/"), slug, F.lit("/"))


def link(root: str, slug: Column, title: Column, label: str = "") -> Column:
    return F.concat(F.lit('<a href="'), unit_path(root, slug), F.lit(f'">{label}'), tx.escape_html(title), F.lit("</a>"))


def navigation(root: str) -> Column:
    """Links to the neighbours ``before`` and ``after``, structs of slug and title."""

    def beside(name: str, label: str, absent: str) -> Column:
        return F.when(F.col(name).isNull(), F.lit(absent)).otherwise(link(root, F.col(f"{name}.slug"), F.col(f"{name}.title"), label))

    return F.concat(F.lit(NAV_OPEN), beside("before", PREVIOUS_LABEL, NO_PREVIOUS), beside("after", NEXT_LABEL, ""), F.lit(NAV_CLOSE))


def contents(units: DataFrame, book: Sequence[str], order: str, root: str) -> DataFrame:
    """List items of the contents in ``order``.  Every page of a book shows the same list, so it is kept once."""
    item = F.concat(F.lit("<li>"), link(root, F.col("slug"), F.col("title")), F.lit("</li>"))
    return units.select(*book, order, "slug", item.alias("html"))


def unit_parts(
    units: DataFrame, pages: DataFrame, sections: DataFrame, book: Sequence[str], order: str, bucket: Column, root: str
) -> DataFrame:
    """Rows (*book, slug, part, page, layer, rank, html) that make up the unit pages, in that order.

    ``units(*book, order, slug, title, first_page, last_page)``, ``pages(*book, page, html)``, ``sections(*book,
    unit, page, rank, slug)``.  A unit has its heading, each expected page, and links to its neighbours in
    the book.  A section whose id the page lacks gets an anchor before it.  An expected page that is not there is a
    row with null html (``missing_pages``).  Pages of overlapping units appear in each.  Null book keys are
    keys like any other.
    """
    place = lambda *more: F.struct(*book, *more).alias("__place")
    unit = F.struct("slug", "title")
    placed = ordered_scan(units, book, bucket, [order], Previous("before", unit), Following("after", unit))

    def row(part: int, html: Column, page: Column = F.lit(None), layer: int = 0, rank: Column = F.lit(None)) -> list[Column]:
        return [
            F.lit(part).alias("part"), page.cast("long").alias("page"), F.lit(layer).alias("layer"), rank.cast("long").alias("rank"),
            html.alias("html"),
        ]

    head = F.concat(F.lit("<h1>"), tx.escape_html(F.col("title")), F.lit("</h1>"))
    ends = placed.select(*book, "slug", F.explode(F.array(F.struct(*row(HEAD, head)), F.struct(*row(NAVIGATION, navigation(root))))).alias("r")).select(
        *book, "slug", "r.*"
    )

    expected = expand(units.select(*book, "slug", "first_page", "last_page"), "first_page", "last_page")
    done = pages.select(place("page"), "html")
    shown = expected.select(*book, "slug", "page", place("page")).join(done, "__place", "left")
    fragments = shown.select(*book, "slug", *row(PAGES, F.col("html"), F.col("page"), FRAGMENT))

    # Only the ids of a page travel to its sections, not its text, and only pages with sections are searched for them.
    spans = units.select(place("slug"), "first_page", "last_page")
    inside = sections.filter(F.col("slug") != "").select("*", place(F.col("unit").alias("slug"))).join(spans, "__place").filter("page between first_page and last_page")
    inside = inside.withColumn("__place", place("page"))
    # Never null, as a null would be looked for in a filter that reads the page once more.
    found = F.coalesce(hx.ids(F.col("html")), F.array().cast("array<string>"))
    marks = done.filter(F.col("html").isNotNull()).join(inside.select("__place"), "__place", "left_semi").select("__place", found.alias("__ids"))
    lacking = inside.join(marks, "__place").filter(~F.array_contains("__ids", F.col("slug")))
    anchor = F.concat(F.lit('<span class="section-anchor" id="'), tx.escape_html(F.col("slug")), F.lit('"></span>'))
    anchors = lacking.select(*book, F.col("unit").alias("slug"), *row(PAGES, anchor, F.col("page"), ANCHOR, F.col("rank")))
    return ends.unionByName(fragments).unionByName(anchors)


def missing_pages(parts: DataFrame, book: Sequence[str]) -> DataFrame:
    """Expected pages that were not there."""
    return parts.filter((F.col("part") == PAGES) & (F.col("layer") == FRAGMENT) & F.col("html").isNull()).select(*book, "slug", "page")


def heading_places(heads: DataFrame, sections: DataFrame, sources: DataFrame, keys: Sequence[str], **boilerplate) -> DataFrame:
    """Where the section titles that lead pages belong.

    ``heads(*keys, page, text)`` are the first texts of the pages, ``sections(*keys, slug, title_en, title_zh, level,
    pdf_page)`` the sections of the units, ``sources(*keys, page, text)`` the source of the pages.  Rows
    (*keys, page, text, slug, section_page, near_top, blocks, after_figure, heading) of the heads that read like a section
    with a page.  For a section that begins on the very page: whether the source has its title at the top of the page,
    how many stretches of prose stand above it, whether a figure does, and the heading to put there; null for
    one that begins on another page, whose source says nothing.  A page without source counts as one with the title at its top.

    What the source says of a title belongs to the section, so it is found once a section, on the source of the
    section's page alone, and the heads meet the sections in one join.  A null key is one more key.
    """
    known = sections.filter(F.col("pdf_page").isNotNull())
    facts = F.min_by(F.struct("title_en", "title_zh", "level", "pdf_page"), "pdf_page").over(Window.partitionBy(*keys, "slug"))
    begun = known.withColumn("__s", facts).withColumn("page", F.col("__s.pdf_page").cast("long"))
    told = sources.select(*keys, F.col("page").cast("long").alias("page"), F.col("text").alias("__source"))
    rows = same_keys(begun, told, [*keys, "page"], "left")
    lines, at, title = F.col("__told.lines"), F.col("__told.at"), F.col("__s.title_en")

    def told_by(lines: Column) -> Column:
        return F.struct(lines.alias("lines"), fr.title_position(lines, title).alias("at"))

    above = F.slice(lines, F.lit(1), F.greatest(at - 1, F.lit(0)))
    read = rows.withColumn("__told", tx.bind(fr.source_lines(F.coalesce("__source", F.lit("")), **boilerplate), told_by)).select(
        *keys, "title_en", "title_zh", "slug", F.col("__s.pdf_page").alias("section_page"),
        # Of several sources of a page one counts, the same for each fact and in every run.
        F.struct("pdf_page", "slug", F.xxhash64("__source")).alias("__rank"),
        fr.title_near_top(lines, title, at).alias("near_top"), fr.prose_blocks_before(lines, title, at).alias("blocks"),
        F.array_join(above, "\n").rlike(FIGURE_OR_TABLE).alias("after_figure"),
        fr.section_heading(F.col("__s.level"), F.col("slug"), F.coalesce("__s.title_zh", "__s.title_en")).alias("heading"),
    )
    here = ["near_top", "blocks", "after_figure", "heading"]
    matched = match_headings(heads, read, keys, "text", ["title_en", "title_zh"], "__rank", ["section_page", *here]).filter("section_slug IS NOT NULL")
    return matched.select(
        *keys, "page", "text", F.col("section_slug").alias("slug"), "section_page",
        *[F.when(F.col("section_page") == F.col("page"), F.col(name)).alias(name) for name in here],
    )


def repair_headings(pages: DataFrame, sections: DataFrame, sources: DataFrame, keys: Sequence[str], **boilerplate) -> DataFrame:
    """``pages(*keys, page, html)`` with the section titles at the head of pages put right: a section of an
    earlier page loses the repeated title, one that begins further down the page gets it moved there.

    Only the first text of a page travels to the sections, and only pages led by a title meet their source.
    """
    heads = pages.select(*keys, "page", fr.leading_text(F.col("html")).alias("text"))  # an empty one reads like no section
    places = heading_places(heads, sections, sources, keys, **boilerplate).select(
        *keys, "page", F.struct("section_page", "near_top", "blocks", "after_figure", "heading").alias("__place")
    )
    place = F.col("__place")
    settled = fr.settle_heading(
        F.col("html"), F.col("page"), place["section_page"], place["near_top"], place["heading"], place["blocks"], place["after_figure"]
    )
    return pages.join(places, [*keys, "page"], "left").select(*keys, "page", settled.alias("html"))
