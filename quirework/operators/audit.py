"""Corpus audit: link integrity, rule packs, leaks, page checks, pass/fail report."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import code as cx
from quirework.functions import html as hx
from quirework.functions import paths as px
from quirework.functions import rules as rx
from quirework.functions import text as tx
from quirework.functions import titles

# --- fixed values -----------------------------------------------------------------
LEAKS_PER_PAGE = 5
REPORT_SAMPLES = 10
TODO_MARKERS = "(?i)TODO|待翻译|未翻译"
STYLESHEET, SCRIPT = "/assets/css/styles.css", "/assets/js/site.js"
EMBEDDED_IMAGE = r"data:image/[^\"']+"
# ----------------------------------------------------------------------------------


def link_edges(pages: DataFrame, path: str, html: str) -> DataFrame:
    """(path, href, target, fragment) of the links that stay within the site."""
    hrefs = pages.select(path, F.explode(hx.links(F.col(html))).alias("href"))
    return _targets(hrefs, path, "href")


def image_edges(pages: DataFrame, path: str, html: str) -> DataFrame:
    srcs = pages.select(path, F.explode(hx.images(F.col(html))).alias("src"))
    return _targets(srcs, path, "src")


def _targets(edges: DataFrame, path: str, reference: str) -> DataFrame:
    placed = edges.withColumn("__t", px.local_target(F.col(path), F.col(reference))).filter("__t IS NOT NULL")
    return placed.select(path, reference, F.col("__t")["path"].alias("target"), F.col("__t")["fragment"].alias("fragment"))


def missing_targets(edges: DataFrame, files: DataFrame, file: str = "file") -> DataFrame:
    """Edges whose target is no file of the site."""
    return edges.join(files.select(F.col(file).alias("target")), "target", "left_anti")


def missing_anchors(edges: DataFrame, files: DataFrame, anchors: DataFrame, file: str = "file") -> DataFrame:
    """Edges with a fragment that their existing target page does not define."""
    known = files.select(F.col(file).alias("target"))
    marked = edges.filter("fragment <> ''").join(known, "target", "left_semi")
    return marked.join(anchors.select(F.col(file).alias("target"), F.col("id").alias("fragment")), ["target", "fragment"], "left_anti")


def page_anchors(pages: DataFrame, path: str, html: str) -> DataFrame:
    return pages.select(F.col(path).alias("file"), F.explode(hx.ids(F.col(html))).alias("id"))


def rule_hits(rows: DataFrame, keys: Sequence[str], text: Column, rules: Sequence[rx.Rule], first_only: bool = False) -> DataFrame:
    """Rule findings as rows: the first matching rule per row, or every one."""
    if first_only:
        hit = rows.select(*keys, rx.first_finding(text, rules).alias("__f")).filter("__f IS NOT NULL")
        return hit.select(*keys, "__f.rule", "__f.matched")
    return rows.select(*keys, F.explode(rx.findings(text, rules)).alias("__f")).select(
        *keys, "__f.rule", "__f.hard", "__f.matched", "__f.hits"
    )


def block_leaks(rows: DataFrame, keys: Sequence[str], blocks: Column, keep: int | None = LEAKS_PER_PAGE, cut: int = 180) -> DataFrame:
    """Leaking blocks of each row in document order, the first ``keep`` of them, cut for
    the report.  Done inside the row, so nothing shuffles."""
    found = F.filter(blocks, lambda b: rx.is_leak(b))
    shown = F.slice(found, 1, keep) if keep else found
    return rows.select(*keys, F.posexplode(shown).alias("leak_no", "block")).select(
        *keys, (F.col("leak_no") + 1).cast("long").alias("leak_no"), F.substring("block", 1, cut).alias("block")
    )


def sentence_leaks(rows: DataFrame, keys: Sequence[str], html: Column, keep: int = LEAKS_PER_PAGE) -> DataFrame:
    found = F.slice(rx.sentence_leaks(hx.visible_text(html)), 1, keep)
    return rows.select(*keys, F.posexplode(found).alias("leak_no", "block")).select(
        *keys, (F.col("leak_no") + 1).cast("long").alias("leak_no"), "block"
    )


def unversioned_assets(html: Column, stylesheet: str, script: str) -> Column:
    """References to the site's stylesheet and script that lack a version."""
    css, js = re.escape(stylesheet), re.escape(script)
    found = F.concat(
        F.slice(F.filter(hx.attribute_values_any(html, "link", "href"), lambda v: v.rlike(rf"\A{css}(?:\?|\z)")), 1, 1),
        F.slice(F.filter(hx.attribute_values_any(html, "script", "src"), lambda v: v.rlike(rf"\A{js}(?:\?|\z)")), 1, 1),
    )
    return F.filter(found, lambda v: ~v.rlike(rf"\A(?:{css}|{js})\?v=[A-Za-z0-9._-]+\z"))


def lacks_sidebar_controls(html: Column) -> Column:
    """A sidebar without both of its expand-all and collapse-all controls."""
    sidebar = html.rlike(r"(?is)<[a-z][^>]*\bclass\s*=\s*[\"'][^\"']*\btutorial-sidebar\b")
    both = html.rlike(r"(?is)data-sidebar-action\s*=\s*[\"']expand[\"']") & html.rlike(
        r"(?is)data-sidebar-action\s*=\s*[\"']collapse[\"']"
    )
    return sidebar & ~both


def unnumbered_sections(html: Column) -> Column:
    """Numbers of numbered sections ("2.1") whose heading does not start with the number."""
    section = r"(?is)<div\b(?=[^>]*\bclass\s*=\s*[\"'][^\"']*\bsection\b)(?=[^>]*\bnumber\s*=\s*[\"'][^\"']+[\"'])[^>]*>\s*(?:<h[2-6]\b[^>]*>.*?</h[2-6]>)?"
    found = F.transform(
        F.regexp_extract_all(html, F.lit(section), F.lit(0)),
        lambda s: F.struct(
            tx.strip(F.regexp_extract(s, r"(?is)\A<div\b[^>]*\bnumber\s*=\s*[\"']([^\"']+)[\"']", 1)).alias("number"),
            hx.node_text(F.regexp_extract(s, r"(?is)(<h[2-6]\b.*)\z", 1)).alias("label"),
        ),
    )
    bad = F.filter(found, lambda s: F.contains(s["number"], F.lit(".")) & ~titles.number_heads_label(s["label"], s["number"]))
    return F.transform(bad, lambda s: s["number"])


def header_artifacts(html: Column) -> Column:
    """Headings and paragraphs that are left-over running headers."""
    texts = F.transform(hx.elements(html, (*hx.HEADING_TAGS, "p")), lambda e: hx.node_text(e))
    return F.filter(texts, lambda t: rx.full_match(t, rx.RUNNING_HEADERS))


def nested_code_tabs(html: Column) -> Column:
    return html.rlike(r"(?i)<pre><code\b[^>]*>\s*<div\b[^>]*class=[\"'][^\"']*\bcode-tabs\b")


def listings_of(pages: DataFrame, keys: Sequence[str], listings: Column) -> DataFrame:
    """(keys, block_no, code) of an array of listings."""
    return pages.select(*keys, F.posexplode(listings).alias("block_no", "code"))


def code_residue(blocks: DataFrame, keys: Sequence[str], keep: int | None = LEAKS_PER_PAGE, cut: int = 500) -> DataFrame:
    """Python listings (keys, block_no, code) that still hold R syntax outside comments: the first ``keep`` per
    page, or all without it, each cut to ``cut`` characters for the report."""
    hits = blocks.filter(rx.hits_any(cx.without_comments(F.col("code")), rx.R_RESIDUE))
    shown = hits.select(*keys, "block_no", F.substring("code", 1, cut).alias("code"))
    if keep is None:
        return shown
    at = Window.partitionBy(*keys).orderBy("block_no")
    return shown.withColumn("__at", F.row_number().over(at)).filter(F.col("__at") <= keep).drop("__at")


def code_errors(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Python listings (keys, block_no, code) that do not parse."""
    checked = blocks.withColumn("error", cx.syntax_error(F.col("code"))).filter("error.message IS NOT NULL")
    return checked.select(*keys, "block_no", "error.line", "error.message")


def misplaced_headings(pages: DataFrame, sections: DataFrame, keys: Sequence[str], html: str, sources: DataFrame | None = None) -> DataFrame:
    """Page sections led by the title of a section that began on an earlier page, or, with the ``sources`` of the
    pages (keys, page, text), of one that the source begins further down the same page."""
    from quirework.operators.book import heading_places

    led = r"(?is)<section\b(?=[^>]*book-page)[^>]*\bdata-pdf-page\s*=\s*[\"'][0-9]+[\"'][^>]*>\s*(?:<h[1-6]\b[^>]*>.*?</h[1-6]>|<p\b[^>]*>.*?</p>)"
    found = pages.select(*keys, F.explode(F.regexp_extract_all(F.col(html), F.lit(led), F.lit(0))).alias("__s")).select(
        *keys,
        F.regexp_extract("__s", r"data-pdf-page\s*=\s*[\"']([0-9]+)[\"']", 1).cast("long").alias("page"),
        hx.node_text(F.regexp_extract("__s", r"(?is)<section\b[^>]*>\s*(.*)\z", 1)).alias("text"),
    )
    told = sources if sources is not None else found.select(*keys, "page", F.lit(None).cast("string").alias("text")).limit(0)
    placed = heading_places(found, sections.withColumn("level", F.lit(1)), told, keys)
    wrong = (F.col("section_page") < F.col("page")) | ((F.col("section_page") == F.col("page")) & ~F.col("near_top"))
    return placed.filter(wrong).select(*keys, "page", "text", F.col("slug").alias("section_slug"), "section_page")


def page_findings(
    pages: DataFrame, file: str, html: str, packs: Sequence[Sequence[rx.Rule]], assets: tuple[str, str] = (STYLESHEET, SCRIPT)
) -> DataFrame:
    """One narrow row per page with all that the checks need, so the pages are read once.

    ``rule_hits`` holds the first finding of each pack in the visible text, ``unversioned`` the references to the
    site's stylesheet and script (``assets``) without a version.  Nothing is cut here.
    """
    page, text = F.col("__html"), F.col("__text")
    seen = pages.select(F.col(file).alias("file"), F.col(html).alias("__html"), hx.visible_text(F.col(html)).alias("__text"))
    return seen.select(
        "file",
        hx.links(page).alias("links"), hx.images(page).alias("images"), hx.ids(page).alias("ids"),
        F.array_compact(F.array(*[rx.first_finding(text, pack) for pack in packs])).alias("rule_hits"),
        hx.bad_preamble(page).alias("bad_preamble"), lacks_sidebar_controls(page).alias("missing_controls"),
        unnumbered_sections(page).alias("missing_numbers"), header_artifacts(page).alias("running_headers"),
        nested_code_tabs(page).alias("nested_code_tabs"), unversioned_assets(page, *assets).alias("unversioned"), hx.code_in_language(page, "python").alias("listings"),
        F.filter(hx.visible_blocks(page), lambda b: rx.is_leak(b)).alias("leaks"),
        tx.count_matches(F.regexp_replace(page, EMBEDDED_IMAGE, "data:image/removed"), TODO_MARKERS).alias("todo_markers"),
    )


def integrity(findings: DataFrame, files: DataFrame, marked: DataFrame | None = None) -> dict[str, DataFrame]:
    """Links, fragments and images without a target.  ``marked(file, ids)`` names the ids of all pages, if
    ``findings`` has only some of them."""
    links = _targets(findings.select("file", F.explode("links").alias("href")), "file", "href")
    images = _targets(findings.select("file", F.explode("images").alias("src")), "file", "src")
    anchors = (findings if marked is None else marked).select("file", F.explode("ids").alias("id"))
    return {
        "missing_links": missing_targets(links, files),
        "missing_anchors": missing_anchors(links, files, anchors),
        "missing_images": missing_targets(images, files),
    }


def findings_report(findings: DataFrame, rows: dict[str, tuple[DataFrame, bool]], soft: Sequence[str] = ("language_leaks",)) -> DataFrame:
    """One row: counts over ``findings`` in one aggregate, a count of each of ``rows(name: (rows, hard))``, and a
    status, ``incomplete`` if a count is not zero that is neither soft nor of the pages."""
    size = lambda column: F.sum(F.size(column).cast("long"))
    counts = {
        "rule_hits": size("rule_hits"),
        "bad_preambles": F.count_if("bad_preamble"),
        "missing_controls": F.count_if("missing_controls"),
        "missing_numbers": size("missing_numbers"),
        "running_headers": size("running_headers"),
        "nested_code_tabs": F.count_if("nested_code_tabs"),
        "unversioned": size("unversioned"),
        "language_leaks": size("leaks"),
        "todo_markers": F.sum("todo_markers"),
    }
    none = F.lit(0).cast("long")
    row = findings.agg(F.count(F.lit(1)).alias("pages"), *[F.coalesce(value, none).alias(name) for name, value in counts.items()])
    row = row.select("*", *[found.agg(F.count(F.lit(1))).scalar().alias(name) for name, (found, _) in rows.items()])
    hard = [name for name in counts if name not in soft] + [name for name, (_, strict) in rows.items() if strict]
    failed = reduce(lambda a, b: a | b, [F.col(name) > 0 for name in hard])
    return row.withColumn("status", F.when(failed, F.lit("incomplete")).otherwise(F.lit("ready")))


def report(tables: Sequence[tuple[DataFrame, Mapping[str, tuple[Column, bool]]]]) -> DataFrame:
    """One row: metrics (aggregate, hard) and a status, ``incomplete`` if a hard one is not zero.

    Each table is read once, for all its metrics together, and the single rows meet in a final one.
    """
    none = F.lit(0).cast("long")
    parts, names = [], []
    for rows, metrics in tables:
        row = rows.agg(*[F.coalesce(value.cast("long"), none).alias(name) for name, (value, _) in metrics.items()])
        entries = [F.struct(F.lit(name).alias("metric"), F.lit(hard).alias("hard"), F.col(name).alias("n")) for name, (_, hard) in metrics.items()]
        parts.append(row.select(F.inline(F.array(*entries))))
        names += metrics
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    failed = F.coalesce(F.bool_or(F.col("hard") & (F.col("n") > 0)), F.lit(False))
    return stacked.agg(
        *[F.sum(F.when(F.col("metric") == name, F.col("n"))).cast("long").alias(name) for name in names],
        F.when(failed, F.lit("incomplete")).otherwise(F.lit("ready")).alias("status"),
    )


def document_report(pages: DataFrame, html: Column, expected: DataFrame, done: DataFrame, key: str, red_flags: Sequence[str] = ()) -> DataFrame:
    """Quality row of rendered documents: missing answers, listings against copy buttons,
    open markers and red flags; embedded images are masked before scanning."""
    scan = F.regexp_replace(html, EMBEDDED_IMAGE, "data:image/removed")
    flags = reduce(lambda a, b: a + b, [tx.count_matches(scan, rf"\Q{f}\E") for f in red_flags], F.lit(0).cast("long"))
    counted = pages.agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(tx.count_matches(html, 'class="r-code-card"')).alias("code_cards"),
        F.sum(tx.count_matches(html, 'class="copy-code"')).alias("copy_buttons"),
        F.sum(tx.count_matches(scan, TODO_MARKERS)).alias("todo_markers"),
        F.sum(flags).alias("red_flags"),
    )
    missing = expected.select(key).join(done.select(key), key, "left_anti").agg(F.count(F.lit(1)))
    row = counted.withColumn("missing_answers", missing.scalar())
    ready = (
        (F.col("documents") > 0)
        & (F.col("missing_answers") == 0)
        & (F.col("code_cards") == F.col("copy_buttons"))
        & (F.col("todo_markers") == 0)
        & (F.col("red_flags") == 0)
    )
    return row.withColumn("status", F.when(ready, F.lit("ready")).otherwise(F.lit("fail")))
