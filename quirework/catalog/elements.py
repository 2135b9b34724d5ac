"""Queries over the elements of ``pages``: outermost blocks, clean bodies, block-wise translation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.catalog.registry import decode, q, query, squash
from quirework.operators import elements as el
from quirework.sources.tables import table


def _in(column: str, values) -> str:
    return f"{column} IN ({', '.join(q(v) for v in values)})"


def _opens(tags=(), classes=()) -> str:
    parts = [_in("tag", tags)] if tags else []
    parts += [f"list_has_any(classes, [{', '.join(q(c) for c in classes)}])"] if classes else []
    return f"coalesce(ends IS NOT NULL AND ({' OR '.join(parts)}), false)"


#: Tokens of every page with the elements they open.
_ELEMENTS = f"""k AS (SELECT page_id, regexp_extract_all(html, {q(el.TOKEN)}) AS k FROM pages),
    t AS (SELECT page_id, unnest(range(len(k))) AS pos, unnest(k) AS token FROM k),
    n AS (SELECT *, lower(regexp_extract(token, {q(el.TAG_NAME)}, 1)) AS name, starts_with(token, '</') AS closing,
      string_split_regex(trim(regexp_extract(token, {q(el.CLASSES)}, 1)), '\\s+') AS classes, (NOT starts_with(token, '<') OR token = '<') AS is_text FROM t),
    m AS (SELECT *, CASE WHEN {_in('name', ('script', 'style', *el.VOID_TAGS))} OR ends_with(token, '/>') THEN '' ELSE name END AS tag FROM n),
    s AS (SELECT *, sum(CASE WHEN tag = '' THEN 0 WHEN closing THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, tag ORDER BY pos) AS total,
      min(CASE WHEN {_in('tag', el.BLOCK_EDGES)} THEN pos END) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS edge,
      1 + max(pos) OVER (PARTITION BY page_id) AS past FROM m),
    l AS (SELECT *, least(0, coalesce(min(total) OVER (PARTITION BY page_id, tag ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low FROM s),
    d AS (SELECT *, CASE WHEN tag = '' OR (closing AND total < low) THEN NULL ELSE total - low + closing::INT END AS depth FROM l),
    o AS (SELECT *, lead(CASE WHEN closing THEN pos END) OVER w AS answer, lag(classes) OVER w AS of FROM d WHERE depth IS NOT NULL WINDOW w AS (PARTITION BY page_id, tag, depth ORDER BY pos)),
    e AS (SELECT d.*, o.answer IS NOT NULL AND NOT d.closing AS closed, CASE WHEN d.depth IS NOT NULL AND NOT d.closing THEN coalesce(o.answer, d.edge, d.past) END AS ends
      FROM d LEFT JOIN o ON o.page_id = d.page_id AND o.pos = d.pos)"""


def _cover(opens: str) -> str:
    return f"coalesce(pos <= max(CASE WHEN {opens} THEN CASE WHEN closed THEN ends ELSE ends - 1 END END) OVER (PARTITION BY page_id ORDER BY pos), false)"


@query(
    f"""WITH {_ELEMENTS},
    u AS (SELECT *, {_cover(_opens(el.UNREAD_TAGS))} AS unread FROM e),
    b AS (SELECT *, ({_opens(el.REVIEW_TAGS, el.REVIEW_CLASSES)} AND NOT unread) AS opens FROM u),
    c AS (SELECT *, max(CASE WHEN opens THEN ends END) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM b),
    f AS (SELECT *, opens AND (until IS NULL OR pos >= until) AS starts FROM c),
    g AS (SELECT *, sum(starts::INT) OVER (PARTITION BY page_id ORDER BY pos) AS block FROM f),
    h AS (SELECT page_id, block, string_agg(token, ' ' ORDER BY pos) FILTER (NOT starts AND pos < until AND NOT unread AND is_text) AS t FROM g GROUP BY ALL),
    i AS (SELECT page_id, block, {squash(decode("coalesce(t, '')"))} AS line FROM h),
    j AS (SELECT page_id, string_agg(line, chr(10) ORDER BY block) FILTER (line <> '') AS text, count(*) FILTER (line <> '') AS n FROM i GROUP BY page_id)
    SELECT p.page_id, coalesce(n, 0)::BIGINT AS n_blocks, coalesce(text, '') AS text FROM pages p LEFT JOIN j ON j.page_id = p.page_id"""
)
def page_outer_text(spark, folder):
    """What a reviewer reads of every page: the texts of its outermost blocks."""
    return el.outer_text(table(spark, folder, "pages", "page_id", "html", spread="page_id"))


_ROOTS = (("article", None), ("main", None), ("body", None))
_SITE = "the"


@query(
    f"""WITH {_ELEMENTS},
    r AS (SELECT page_id, arg_min({{'a': pos, 'z': CASE WHEN closed THEN ends ELSE ends - 1 END, 'tag': tag}}, {{'k': list_position(['article', 'main', 'body'], tag), 'p': pos}}) AS root
      FROM e WHERE ends IS NOT NULL AND tag IN ('article', 'main', 'body') GROUP BY page_id),
    b AS (SELECT e.*, root FROM e LEFT JOIN r USING (page_id) WHERE root IS NULL OR pos BETWEEN root.a AND root.z),
    h AS (SELECT page_id, arg_min({{'a': pos, 'z': ends}}, pos) AS h1 FROM b WHERE ends IS NOT NULL AND tag = 'h1' GROUP BY page_id),
    tt AS (SELECT page_id, {squash(decode("string_agg(token, ' ' ORDER BY pos)"))} AS said FROM b JOIN h USING (page_id) WHERE is_text AND pos > h1.a AND pos < h1.z GROUP BY page_id),
    x AS (SELECT b.*, ({_opens(('nav', 'footer'), ('ad',))} OR coalesce(pos = h1.a AND contains(said, '{_SITE}'), false)) AS gone FROM b LEFT JOIN h USING (page_id) LEFT JOIN tt USING (page_id)),
    y AS (SELECT *, {_cover('gone')} AS out FROM x),
    z AS (SELECT page_id, coalesce(any_value(root).tag, '') AS root, coalesce(string_agg(token, '' ORDER BY pos) FILTER (NOT out), '') AS body FROM y GROUP BY page_id)
    SELECT p.page_id, coalesce(root, '') AS root, coalesce(body, '') AS body FROM pages p LEFT JOIN z ON z.page_id = p.page_id"""
)
def page_clean_body(spark, folder):
    """The article of every page without navigation, advertisements, footer and a heading that names the site."""
    pages = table(spark, folder, "pages", "page_id", "html", spread="page_id")
    return el.clean_body(pages, _ROOTS, drop_tags=("nav", "footer"), drop_classes=("ad",), title=_SITE)


@query(
    f"""WITH {_ELEMENTS},
    u AS (SELECT *, {_cover(_opens(el.UNREAD_TAGS))} AS unread,
      sum((({_in('tag', el.UNTRANSLATED_INSIDE)} AND NOT closing) OR {_in('name', ('script', 'style'))})::INT) OVER (PARTITION BY page_id ORDER BY pos) AS barred,
      sum((is_text AND regexp_matches(token, {q(el.LETTER)}))::INT) OVER (PARTITION BY page_id ORDER BY pos) AS letters FROM e),
    v AS (SELECT a.*, z.barred - a.barred AS bars, z.letters - a.letters AS words FROM u a LEFT JOIN u z ON z.page_id = a.page_id AND z.pos = a.ends - 1),
    b AS (SELECT *, ({_opens(el.TRANSLATED_TAGS)} AND NOT unread AND bars = 0 AND words > 0) AS opens FROM v),
    c AS (SELECT *, max(CASE WHEN opens THEN ends END) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM b),
    f AS (SELECT *, opens AND (until IS NULL OR pos >= until) AS starts FROM c),
    g AS (SELECT *, sum(starts::INT) OVER (PARTITION BY page_id ORDER BY pos) - starts::INT AS block, NOT starts AND coalesce(pos < until, false) AS inside FROM f),
    i AS (SELECT page_id, block, inside, min(pos) AS pos, string_agg(token, '' ORDER BY pos) AS text FROM g GROUP BY ALL),
    answers AS (SELECT doc_id AS page_id, unnest(string_split(text, chr(10))) AS answer, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS block
      FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
    j AS (SELECT i.*, CASE WHEN inside AND trim(answer, ' ') <> '' THEN answer END AS put FROM i LEFT JOIN answers a ON a.page_id = i.page_id AND a.block = i.block AND inside)
    SELECT page_id, string_agg(coalesce(put, text), '' ORDER BY pos) AS html, count(*) FILTER (inside) AS blocks, count(put) AS translated FROM j GROUP BY page_id"""
)
def page_block_translate(spark, folder):
    """Every page with its blocks replaced by the lines of the good document of its number, as far as those reach."""
    pieces = el.block_pieces(table(spark, folder, "pages", "page_id", "html", spread="page_id"))
    good = table(spark, folder, "labels", "doc_id", "quality").filter("quality = 1").select("doc_id")
    texts = table(spark, folder, "documents", "doc_id", "text").join(good, "doc_id", "left_semi")
    lines = texts.select(F.col("doc_id").alias("page_id"), F.posexplode(F.split("text", "\n")).alias("sequence", "answer"))
    answers = lines.select("page_id", (F.col("sequence") + 1).cast("long").alias("block"), "answer", "sequence")
    return el.translate_blocks(pieces, answers)
