"""HTML queries over ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.catalog.registry import count, decode, found, hrefs, markup, node_text, q, query, squash, sub, visible
from quirework.catalog.texts import JUNK, _all_hits
from quirework.functions import html as hx
from quirework.functions import paths as px
from quirework.functions import rules as rx
from quirework.functions import text as tx
from quirework.operators import audit
from quirework.session import materialize
from quirework.sources.tables import table



@query(
    f"""WITH v AS (SELECT page_id, {visible('html')} AS t, len({hrefs('html')}) AS links FROM pages)
    SELECT page_id, length(t)::BIGINT AS chars, {count('t', tx.LATIN)}::BIGINT AS latin, {count('t', tx.CJK)}::BIGINT AS cjk,
      {count('t', tx.READING_UNIT)}::BIGINT AS units, links::BIGINT AS links, md5(t) AS digest FROM v"""
)
def page_text_profile(spark, folder):
    """Visible text of each page with its letter counts, reading units and links."""
    pages = table(spark, folder, "pages", "page_id", "html", spread="page_id")
    seen = pages.select("page_id", hx.visible_text(F.col("html")).alias("t"), F.size(hx.links(F.col("html"))).cast("long").alias("links"))
    t = F.col("t")
    return seen.select(
        "page_id", F.length(t).cast("long").alias("chars"), tx.latin_count(t).alias("latin"), tx.cjk_count(t).alias("cjk"),
        tx.count_matches(t, tx.READING_UNIT).alias("units"), "links", F.md5(t).alias("digest"),
    )


@query(f"SELECT page_id, generate_subscripts(l, 1)::BIGINT AS link_no, unnest(l) AS href FROM (SELECT page_id, {hrefs('html')} AS l FROM pages)")
def page_links(spark, folder):
    rows = table(spark, folder, "pages", "page_id", "html", spread="page_id").select("page_id", F.posexplode(hx.links(F.col("html"))).alias("p", "href"))
    return rows.select("page_id", (F.col("p") + 1).cast("long").alias("link_no"), "href")


@query(
    f"""WITH e AS (SELECT page_id, unnest({hrefs('html')}) AS href FROM pages)
    SELECT href, count(*)::BIGINT AS links, count(DISTINCT page_id)::BIGINT AS pages FROM e GROUP BY href"""
)
def page_link_counts(spark, folder):
    """How often and from how many pages each address is linked."""
    edges = table(spark, folder, "pages", "page_id", "html", spread="page_id").select("page_id", F.explode(hx.links(F.col("html"))).alias("href"))
    # One row per (address, page) first: a hot address is spread over its pages.
    per_page = edges.groupBy("href", "page_id").agg(F.count(F.lit(1)).alias("n"))
    return per_page.groupBy("href").agg(F.sum("n").alias("links"), F.count(F.lit(1)).alias("pages"))


_SHOWN = sub(sub("html", hx.HIDDEN_ELEMENT), hx.COMMENT)
_LATEX = sub(sub(sub(sub(node_text("b"), r"(?s)\\\[.*?\\\]"), r"(?s)\\begin\{equation\*?\}.*?\\end\{equation\*?\}"), r"(?s)\\begin\{split\}.*?\\end\{split\}"), r"(?s)\\\(.*?\\\)")
_BLOCKS = f"list_filter(list_transform({found(_SHOWN, hx.element_pattern(hx.BLOCK_TAGS))}, lambda b: {squash(_LATEX)}), lambda b: b <> '')"


@query(f"SELECT page_id, generate_subscripts(l, 1)::BIGINT AS block_no, unnest(l) AS block FROM (SELECT page_id, {_BLOCKS} AS l FROM pages)")
def page_blocks(spark, folder):
    """Texts of the block elements in document order."""
    rows = table(spark, folder, "pages", "page_id", "html", spread="page_id").select("page_id", F.posexplode(hx.visible_blocks(F.col("html"))).alias("p", "block"))
    return rows.select("page_id", (F.col("p") + 1).cast("long").alias("block_no"), "block")


def _leaking(source: str) -> str:
    """SQL rows (page_id, block, r) of the leaking blocks of ``source(page_id, html)``."""
    return f"""SELECT page_id, block, row_number() OVER (PARTITION BY page_id ORDER BY n) AS r FROM (
        SELECT *, {sub('block', rf'https?://[^\n{tx.BLANK_CHARS}]+')} AS bare FROM (
          SELECT page_id, generate_subscripts(l, 1) AS n, unnest(l) AS block FROM (SELECT page_id, {_BLOCKS} AS l FROM {source})))
      WHERE {squash("replace(bare, '↩︎', '')")} <> '' AND (regexp_matches(bare, {q(rx.SECTION_WORDS)}) OR
        ({count('bare', tx.LATIN)} >= 80 AND ({count('bare', tx.CJK)} < 20 OR {count('bare', tx.LATIN)} > 2 * {count('bare', tx.CJK)})))"""


@query(f"SELECT page_id, r::BIGINT AS leak_no, left(block, 180) AS block FROM ({_leaking('pages')}) WHERE r <= 5")
def page_language_leaks(spark, folder):
    pages = table(spark, folder, "pages", "page_id", "html", spread="page_id")
    return audit.block_leaks(pages, ["page_id"], hx.visible_blocks(F.col("html")))


def _first(tag: str) -> str:
    return node_text(f"regexp_extract({markup('html')}, {q(hx.element_pattern([tag], capture=True))}, 1)")


@query(f"SELECT page_id, {_first('title')} AS title, {_first('h1')} AS heading FROM pages")
def page_title_heading(spark, folder):
    return table(spark, folder, "pages", "page_id", "html", spread="page_id").select(
        "page_id", hx.first_element_text(F.col("html"), "title").alias("title"), hx.first_element_text(F.col("html"), "h1").alias("heading")
    )


_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
_PATH = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*', '')"
_TRIMMED = f"trim({_PATH}, '/')"


@query(
    f"""SELECT page_id, {_HOST} AS host,
      CASE WHEN {_HOST} LIKE '%.example.org' THEN NULL ELSE '/' || regexp_replace({_TRIMMED}, '\\.html$', '') END AS path,
      replace(regexp_replace({_TRIMMED}, '\\.html$', ''), '/', '-') AS slug,
      '/site/' || replace(regexp_replace({_TRIMMED}, '\\.html$', ''), '/', '-') || '/' AS local_url,
      regexp_replace(regexp_extract({_TRIMMED}, '([^/]*)$', 1), '\\.html$', '') || '-' || left(sha1(url), 12)
        || CASE WHEN {_TRIMMED} LIKE '%.html' THEN '.html' ELSE '.png' END AS copy_name
    FROM pages"""
)
def page_host_path(spark, folder):
    """Host, rooted path (NULL for a foreign host), slug, local address and copy name."""
    url = F.col("url")
    host = px.host(url)
    bare = F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace(px.url_path(url), r"\A/+|/+\z", ""), r"\.html\z", ""))
    return table(spark, folder, "pages", "page_id", "url").select(
        "page_id",
        host.alias("host"),
        px.normalize_path(url, lambda h: ~h.endswith(".example.org")).alias("path"),
        px.page_slug(bare).alias("slug"),
        px.site_url(bare, "site").alias("local_url"),
        tx.localized_name(url).alias("copy_name"),
    )


# The file a page is: its path without the language folder, so that some links resolve.
_FILE = f"'/' || regexp_replace({_TRIMMED}, '\\.html$', '') || '/index.html'"
_TARGET = "CASE WHEN ends_with(href, '/') OR NOT regexp_matches(regexp_extract(href, '([^/]*)/*$', 1), '[^.].*\\.[^.]+$|^[^.]+\\.[^.]+$') THEN regexp_replace(href, '/+$', '') || '/index.html' ELSE href END"


def _files(spark, folder):
    pages = table(spark, folder, "pages", "page_id", "url", "html", spread="page_id")
    path = F.regexp_replace(F.regexp_replace(px.url_path(F.col("url")), r"\A/+|/+\z", ""), r"\.html\z", "")
    return pages.withColumn("file", F.concat(F.lit("/"), path, F.lit("/index.html")))


@query(
    f"""WITH f AS (SELECT page_id, {_FILE} AS file, {hrefs('html')} AS l FROM pages), e AS (SELECT file, unnest(l) AS href FROM f),
    t AS (SELECT file, href, {_TARGET} AS target FROM e WHERE NOT regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:|^//'))
    SELECT file, href, target FROM t WHERE target NOT IN (SELECT file FROM f)"""
)
def broken_links(spark, folder):
    """Links whose target file does not exist."""
    files = _files(spark, folder)
    edges = audit.link_edges(files, "file", "html")
    return audit.missing_targets(edges, files.select("file").distinct()).select("file", "href", "target")


# Pages with an id, a link to an id of their own address, and an image.
_FURNISHED = f"""SELECT page_id, {_FILE} AS file, html || '<p id="a' || page_id % 7 || '">x</p><a href="' || {_FILE} || '#a' || page_id % 5
    || '">x</a><a href="/gone/index.html#a1">x</a><img alt="" src="/img/' || page_id % 40 || '.png">' AS html FROM pages"""


def _furnished(spark, folder):
    n = F.col("page_id")
    more = F.concat(
        F.lit('<p id="a'), (n % 7).cast("string"), F.lit('">x</p><a href="'), F.col("file"), F.lit("#a"), (n % 5).cast("string"),
        F.lit('">x</a><a href="/gone/index.html#a1">x</a><img alt="" src="/img/'), (n % 40).cast("string"), F.lit('.png">'),
    )
    return _files(spark, folder).select("page_id", "file", F.concat("html", more).alias("html"))


_IDS = found(markup("html"), hx.attribute_pattern("[a-z][a-z0-9]*", "id"), 1)
_BARE = r"\A[\"']|[\"']\z"


@query(
    f"""WITH f AS ({_FURNISHED}), a AS (SELECT DISTINCT file, {sub('v', _BARE, '')} AS id FROM (SELECT file, unnest({_IDS}) AS v FROM f)),
    e AS (SELECT file AS origin, split_part(href, '#', 1) AS href, split_part(href, '#', 2) AS fragment FROM (SELECT file, unnest({hrefs('html')}) AS href FROM f)),
    t AS (SELECT origin, fragment, {_TARGET} AS target FROM e WHERE fragment <> '' AND NOT regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:|^//'))
    SELECT origin AS file, target, fragment FROM t WHERE target IN (SELECT file FROM f) AND (target, fragment) NOT IN (SELECT file, id FROM a)"""
)
def broken_fragments(spark, folder):
    """Links to an existing page that lacks the id they point to."""
    pages = _furnished(spark, folder)
    edges = audit.link_edges(pages, "file", "html")
    files = pages.select("file").distinct()
    return audit.missing_anchors(edges, files, audit.page_anchors(pages, "file", "html").distinct()).select("file", "target", "fragment")


@query(
    f"""WITH f AS ({_FURNISHED}), e AS (SELECT file, page_id FROM f)
    SELECT file, '/img/' || page_id % 40 || '.png' AS target FROM e WHERE page_id % 40 NOT IN (SELECT n_nationkey FROM nation)"""
)
def missing_images(spark, folder):
    """Images that are no file of the site."""
    there = table(spark, folder, "nation", "n_nationkey").select(F.concat(F.lit("/img/"), F.col("n_nationkey").cast("string"), F.lit(".png")).alias("file"))
    return audit.missing_targets(audit.image_edges(_furnished(spark, folder), "file", "html"), there).select("file", "target")


# What the checks look for, put into some of the pages.
_PLANTED = (
    (9, "<p>TODO ######## x</p>"),
    (10, "<h2>12 第 3 章 风险</h2>"),
    (12, '<div class="section" number="2.2"><h2>2.2 b</h2></div>'),
    (13, '<div class="section" number="2.1"><h2>a</h2></div>'),
    (15, '<div class="tutorial-sidebar"><b data-sidebar-action="expand">+</b></div>'),
    (16, '<pre><code><div class="code-tabs">x</div></code></pre>'),
    (17, '<code class="language-python">library(x)</code>'),
    (18, '<link rel="stylesheet" href="/assets/css/styles.css">'),
    (19, '<script src="/assets/js/site.js?v=1.2"></script>'),
    (21, "<p>见原教程</p>"),
)
_AUDITED = f"""SELECT page_id, file, CASE WHEN page_id % 14 = 0 THEN 'html' || chr(10) ELSE '' END || html || {
    ' || '.join(f"CASE WHEN page_id % {n} = 0 THEN {q(v)} ELSE '' END" for n, v in _PLANTED)} AS html FROM ({_FURNISHED})"""
_SHOWN_ANY = lambda pack: " OR ".join(f"regexp_matches(t, {q(r.regex)})" for r in pack)
_MASKED = sub("html", audit.EMBEDDED_IMAGE, "data:image/removed")
_ELEMENTS = f"list_transform({found('html', hx.element_pattern((*hx.HEADING_TAGS, 'p')))}, lambda b: {node_text('b')})"


@query(
    f"""WITH f AS ({_AUDITED}), v AS (SELECT {visible('html')} AS t FROM f), a AS (SELECT DISTINCT file, {sub('v', _BARE, '')} AS id FROM (SELECT file, unnest({_IDS}) AS v FROM f)),
    e AS (SELECT split_part(href, '#', 1) AS href, split_part(href, '#', 2) AS fragment FROM (SELECT unnest({hrefs('html')}) AS href FROM f)),
    t AS (SELECT fragment, {_TARGET} AS target FROM e WHERE NOT regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:|^//')),
    r AS (SELECT (SELECT count(*) FROM f) AS pages,
      (SELECT count(*) FROM v WHERE {_SHOWN_ANY(rx.SYMBOL_ARTIFACTS)}) + (SELECT count(*) FROM v WHERE {_SHOWN_ANY(rx.BAD_VISIBLE_TEXT)})
        + (SELECT count(*) FROM v WHERE {_SHOWN_ANY(rx.BAD_NOTES)}) AS rule_hits,
      (SELECT count(*) FROM f WHERE lower(trim(split_part(html, chr(10), 1))) = 'html' OR lower(trim(split_part(html, chr(10), 1))) LIKE '<html%') AS bad_preambles,
      (SELECT count(*) FROM f WHERE page_id % 15 = 0) AS missing_controls, (SELECT count(*) FROM f WHERE page_id % 13 = 0) AS missing_numbers,
      (SELECT count(*) FROM (SELECT unnest({_ELEMENTS}) AS b FROM f) WHERE {' OR '.join(f'regexp_full_match(b, {q(p)})' for p in rx.RUNNING_HEADERS)}) AS running_headers,
      (SELECT count(*) FROM f WHERE page_id % 16 = 0) AS nested_code_tabs,
      (SELECT count(*) FROM f WHERE page_id % 18 = 0) AS unversioned, (SELECT count(*) FROM f WHERE page_id % 17 = 0) AS code_residue, (SELECT count(*) FROM ({_leaking('f')})) AS language_leaks,
      (SELECT coalesce(sum({count(_MASKED, audit.TODO_MARKERS)}), 0)::BIGINT FROM f) AS todo_markers,
      (SELECT count(*) FROM t WHERE target NOT IN (SELECT file FROM f)) AS missing_links,
      (SELECT count(*) FROM t WHERE fragment <> '' AND target IN (SELECT file FROM f) AND (target, fragment) NOT IN (SELECT file, id FROM a)) AS missing_anchors,
      (SELECT count(*) FROM f WHERE page_id % 40 NOT IN (SELECT n_nationkey FROM nation)) AS missing_images)
    SELECT *, CASE WHEN rule_hits + bad_preambles + missing_controls + missing_numbers + running_headers + nested_code_tabs + unversioned + code_residue + todo_markers + missing_links + missing_anchors + missing_images > 0
      THEN 'incomplete' ELSE 'ready' END AS status FROM r"""
)
def audit_report(spark, folder):
    """Every check of the audit over pages that hold what it looks for, counted from one reading."""
    n = F.col("page_id")
    planted = [F.when(n % k == 0, F.lit(v)).otherwise("") for k, v in _PLANTED]
    pages = _furnished(spark, folder).select(
        "file", F.concat(F.when(n % 14 == 0, "html\n").otherwise(""), "html", *planted).alias("html")
    )
    found = materialize(audit.page_findings(pages, "file", "html", [rx.SYMBOL_ARTIFACTS, rx.BAD_VISIBLE_TEXT, rx.BAD_NOTES]))
    there = table(spark, folder, "nation", "n_nationkey").select(F.concat(F.lit("/img/"), F.col("n_nationkey").cast("string"), F.lit(".png")).alias("file"))
    broken = audit.integrity(found, found.select("file").unionByName(there).distinct())
    residue = audit.code_residue(audit.listings_of(found, ["file"], F.col("listings")), ["file"], keep=None)
    return audit.findings_report(found, {name: (rows, True) for name, rows in {**broken, "code_residue": residue}.items()})


@query(
    f"""WITH s AS (SELECT DISTINCT '/' || lower(regexp_extract({_first('h1')}, '([A-Za-z]+)', 1)) AS section FROM pages),
    e AS (SELECT page_id, unnest({hrefs('html')}) AS href FROM pages),
    t AS (SELECT page_id, href, '/' || lower(split_part(ltrim(href, '/'), '/', 1)) AS target FROM e)
    SELECT page_id, href, target FROM t WHERE target NOT IN (SELECT section FROM s)"""
)
def broken_section_links(spark, folder):
    """Links whose first path segment is no section; a page's heading opens a section."""
    pages = table(spark, folder, "pages", "page_id", "html", spread="page_id")
    first_word = F.lower(F.regexp_extract(hx.first_element_text(F.col("html"), "h1"), "([A-Za-z]+)", 1))
    sections = pages.select(F.concat(F.lit("/"), first_word).alias("target")).distinct()
    edges = pages.select("page_id", F.explode(hx.links(F.col("html"))).alias("href"))
    edges = edges.withColumn("target", F.concat(F.lit("/"), F.lower(F.split_part(F.regexp_replace("href", r"\A/+", ""), F.lit("/"), F.lit(1)))))
    return edges.join(sections, "target", "left_anti").select("page_id", "href", "target")


@query(
    f"""WITH r AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'html' || chr(10) || regexp_replace(html, '(?i)^<!doctype[^>]*>', '')
        WHEN 1 THEN regexp_replace(html, '(?i)^<!doctype[^>]*>', '') WHEN 2 THEN html ELSE ' ' || html END AS raw FROM pages)
    SELECT page_id, lower(trim(split_part(raw, chr(10), 1))) = 'html' OR lower(trim(split_part(raw, chr(10), 1))) LIKE '<html%' AS bad,
      CASE page_id % 4 WHEN 0 THEN true WHEN 1 THEN true ELSE false END AS repaired FROM r"""
)
def page_preamble_audit(spark, folder):
    """Pages that start with a bare ``html`` or their root element, and what the writer's
    repair changes; a page in four keeps each kind of damage."""
    pages = table(spark, folder, "pages", "page_id", "html", spread="page_id")
    bare = F.regexp_replace(F.col("html"), r"(?i)\A<!doctype[^>]*>", "")
    kind = F.col("page_id") % 4
    raw = F.when(kind == 0, F.concat(F.lit("html\n"), bare)).when(kind == 1, bare).when(kind == 2, F.col("html")).otherwise(F.concat(F.lit(" "), F.col("html")))
    fixed = pages.select("page_id", raw.alias("raw")).withColumn("fixed", hx.repair_doctype(F.col("raw")))
    return fixed.select(
        "page_id",
        hx.bad_preamble(F.col("raw")).alias("bad"),
        (F.col("fixed").startswith("<!doctype html>\n<html") & ~F.col("raw").startswith("<!doctype")).alias("repaired"),
    )


@query(_all_hits(rx.SYMBOL_ARTIFACTS + JUNK, f"(SELECT page_id, {visible('html')} AS t FROM pages)", "page_id", "t"))
def page_rule_hits(spark, folder):
    """Rule findings in the visible text of the pages."""
    pages = table(spark, folder, "pages", "page_id", "html", spread="page_id").select("page_id", hx.visible_text(F.col("html")).alias("t"))
    return audit.rule_hits(pages, ["page_id"], F.col("t"), rx.SYMBOL_ARTIFACTS + JUNK)


_DECODED = decode(f"lower({visible('html')})")


@query(
    f"""WITH h AS (SELECT page_id, {found("regexp_replace(html, '(?i)<(/?)p>', '<\\1h2>', 'g')".replace("html", markup('html')), hx.element_pattern(['h2', 'h3']))} AS l FROM pages)
    SELECT page_id, generate_subscripts(l, 1)::BIGINT AS entry_no, 'section-' || generate_subscripts(l, 1) AS anchor, {node_text('unnest(l)')} AS text
    FROM h WHERE len(l) >= 3"""
)
def page_article_toc(spark, folder):
    """Article contents: entries only for pages with three headings or more.  The pages have
    no second-level headings, so their paragraphs stand in."""
    pages = table(spark, folder, "pages", "page_id", "html", spread="page_id")
    markup_ = F.regexp_replace(hx.markup_only(F.col("html")), "(?i)<(/?)p>", "<$1h2>")
    rows = pages.select("page_id", F.posexplode(hx.article_toc(markup_)).alias("p", "e"))
    return rows.select(
        "page_id", (F.col("p") + 1).cast("long").alias("entry_no"), F.col("e")["anchor"].alias("anchor"), F.col("e")["text"].alias("text")
    )


@query(
    f"""SELECT page_id, regexp_extract(html, '(?i)<html lang="([a-z]+)"', 1) AS lang, contains({_DECODED}, ' the ') AS has_the,
       {count('html', '(?i)<li>')}::BIGINT AS items FROM pages"""
)
def page_attributes(spark, folder):
    """Language attribute and list items per page."""
    pages = table(spark, folder, "pages", "page_id", "html", spread="page_id")
    shown = tx.decode_entities(F.lower(hx.visible_text(F.col("html"))))
    return pages.select(
        "page_id",
        F.get(hx.attribute_values_any(F.col("html"), "html", "lang"), F.lit(0)).alias("lang"),
        shown.contains(" the ").alias("has_the"),
        tx.count_matches(F.col("html"), "(?i)<li>").alias("items"),
    )


@query(
    f"""WITH m AS (SELECT DISTINCT '/' || lower(n_name) AS path FROM nation UNION SELECT DISTINCT '/' || lower(split_part(p_name, ' ', 1)) FROM part
      UNION SELECT '/the' UNION SELECT '/la' UNION SELECT '/der'),
    p AS (SELECT page_id, string_split(html, 'href="') AS parts FROM pages),
    u AS (SELECT page_id, generate_subscripts(parts, 1) AS n, unnest(parts) AS part FROM p),
    r AS (SELECT page_id, n, CASE WHEN n = 1 THEN part WHEN m.path IS NOT NULL THEN 'href="/local' || m.path || '/' || substr(part, strpos(part, '"'))
      ELSE 'href="' || part END AS piece FROM u LEFT JOIN m ON n > 1 AND m.path = split_part(part, '"', 1))
    SELECT page_id, md5(string_agg(piece, '' ORDER BY n)) AS digest FROM r GROUP BY page_id"""
)
def page_rewrite_links(spark, folder):
    """Pages with the links to known paths replaced by local addresses."""
    from quirework.sources.corpus import rewrite_links

    pages = table(spark, folder, "pages", "page_id", "html", spread="page_id")
    names = table(spark, folder, "nation", "n_name").select(F.lower("n_name").alias("w")).unionByName(
        table(spark, folder, "part", "p_name").select(F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("w"))
    )
    extra = names.select(F.explode(F.array(F.col("w"), F.lit("the"), F.lit("la"), F.lit("der"))).alias("w")).distinct()
    mapping = extra.select(F.concat(F.lit("/"), "w").alias("path"), F.concat(F.lit("/local/"), "w", F.lit("/")).alias("local_path"))
    return rewrite_links(pages, mapping, "page_id", "html", []).select("page_id", F.md5("html").alias("digest"))
