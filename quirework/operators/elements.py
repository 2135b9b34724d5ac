"""Elements of pages as token rows: outermost blocks, clean bodies, block-wise translation.

A page becomes one row per tag, comment or stretch of text.  Start and end tags of one name are matched by a running depth, as
balanced parentheses are: a stray end tag would make the depth a new minimum and counts for nothing, a start tag pairs with the
next end tag of its depth.  An element whose end tag is missing ends where the next block's tag stands.
All windows are inside one page, whose html is a single value to begin with, and share one shuffle, of the pages before they
are cut into tokens, into partitions of about equal text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import fragments as fr
from quirework.functions import text as tx

# --- fixed values -----------------------------------------------------------------
REVIEW_TAGS = ("h1", "h2", "h3", "h4", "p", "li", "table", "caption", "blockquote")
REVIEW_CLASSES = ("describe", "example", "exercise", "goals")
UNREAD_TAGS = ("script", "style", "pre", "code", "math", "svg")
#: A block that holds one of these is not translated as a whole.
UNTRANSLATED_INSIDE = ("pre", "script", "style", "svg", "table")
TRANSLATED_TAGS = ("h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "caption", "th", "td", "blockquote", "figcaption")
# ----------------------------------------------------------------------------------
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
#: Where one of these begins or ends, an element without end tag is over.
BLOCK_EDGES = (
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "html", "li", "main", "nav", "ol", "p", "pre", "section", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
)
#: Scripts, styles and comments are one token each, as their content is no markup.
TOKEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<[^<>]*>|[^<]+|<"
TAG_NAME = r"(?i)\A</?([a-z][a-z0-9]*)"
CLASSES = r"(?is)\A<[a-z][a-z0-9]*\s(?:[^>]*?\s)?class\s*=\s*[\"']([^\"']*)[\"']"
LETTER = "[A-Za-z]"


#: Characters of html that one partition of token rows is meant to hold.
PART_CHARS = 2_000_000


def token_parts(pages: DataFrame, html: str = "html") -> int:
    """Partitions of token rows: as many as the pages have ``PART_CHARS``, so a task sorts no more however many pages there are."""
    total = pages.agg(F.sum(F.char_length(html))).first()[0] or 0
    return max(1, -(-total // PART_CHARS))


def page_tokens(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``row, <key>, pos, token, tag, closing, classes``: tokens in order, ``tag`` empty for text, comments, scripts and void
    elements.  ``row`` tells rows with one key apart.  A null or empty page keeps one row without token."""
    tokens = F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))
    told = pages.select(F.monotonically_increasing_id().alias("row"), key, html).repartition(token_parts(pages, html), "row")
    rows = told.select("row", key, F.posexplode_outer(tokens).alias("pos", "token"))
    name = F.lower(F.regexp_extract("token", TAG_NAME, 1))
    plain = F.col("token").isNull() | name.isin("script", "style", *VOID_TAGS) | F.endswith("token", F.lit("/>"))
    return rows.select(
        "row", key, "pos", "token", F.when(plain, F.lit("")).otherwise(name).alias("tag"),
        F.startswith("token", F.lit("</")).alias("closing"),
        F.split(F.trim(F.regexp_extract("token", CLASSES, 1)), r"\s+").alias("classes"),
    )


def is_text(token: Column) -> Column:
    return ~F.startswith(token, F.lit("<")) | (token == "<")


def with_elements(tokens: DataFrame, *, counts: dict[str, Column] | None = None) -> DataFrame:
    """Tokens with the element that each start tag opens: ``end``, the position of its end tag or of the tag that ends
    it, ``closed``, and ``partner``, on an end tag the classes of its start tag.  For each of ``counts`` (name to condition on a
    token) also how many such tokens the element holds."""
    counts = counts or {}
    page = Window.partitionBy("row").orderBy("pos")
    so_far = page.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = Window.partitionBy("row").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("row")
    numbered = tokens.select("*", *[F.count_if(c).over(so_far).alias(f"__{n}") for n, c in counts.items()])
    own = {n: F.when(F.coalesce(c, F.lit(False)), 1).otherwise(0) for n, c in counts.items()}
    here = F.struct(F.col("pos").alias("at"), *[(F.col(f"__{n}") - c).alias(n) for n, c in own.items()])  # counts before the token
    edge = F.when(F.col("tag").isin(*BLOCK_EDGES), here)
    last = F.struct((F.max("pos").over(whole) + 1).alias("at"), *[F.max(f"__{n}").over(whole).alias(n) for n in counts])
    rows = numbered.select("*", F.last(edge, ignorenulls=True).over(later).alias("__edge"), last.alias("__last"), here.alias("__here"))
    named = Window.partitionBy("row", "tag").orderBy("pos")
    rows = rows.withColumn("__sum", F.sum(F.when(F.col("tag") == "", 0).when(F.col("closing"), -1).otherwise(1)).over(named.rowsBetween(Window.unboundedPreceding, 0)))
    lowest = F.least(F.lit(0), F.coalesce(F.min("__sum").over(named.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("__low", lowest)
    stray = F.col("closing") & (F.col("__sum") < F.col("__low"))
    opens = (F.col("tag") != "") & ~F.col("closing")
    # A depth above the lowest sum so far; an end tag stands at the depth of its start tag, a stray one at none.
    level = F.when(opens, F.col("__sum") - F.col("__low")).when((F.col("tag") != "") & ~stray, F.col("__sum") - F.col("__low") + 1)
    paired = Window.partitionBy("row", "tag", "__level").orderBy("pos")
    rows = rows.withColumn("__level", level)
    answer = F.when(F.lead("closing").over(paired) & F.col("__level").isNotNull(), F.lead("__here").over(paired))
    rows = rows.select(
        "*", F.when(opens, answer).alias("__answer"),
        F.when(F.col("closing") & F.col("__level").isNotNull(), F.lag("classes").over(paired)).alias("partner"),
    )
    over = F.when(opens, F.coalesce("__answer", "__edge", "__last"))
    return rows.withColumn("__over", over).select(
        *tokens.columns, F.col("__over.at").alias("end"), F.col("__answer").isNotNull().alias("closed"), "partner",
        *[(F.col(f"__over.{n}") - F.col(f"__here.{n}")).alias(n) for n in counts],
    )


def covered(rows: DataFrame, name: str, opens: Column) -> DataFrame:
    """Whether a token lies inside one of the elements that begin at ``opens``, their own tags included."""
    until = F.max(F.when(opens, F.when(F.col("closed"), F.col("end")).otherwise(F.col("end") - 1)))
    page = Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(name, F.coalesce(F.col("pos") <= until.over(page), F.lit(False)))


def outermost(rows: DataFrame, opens: Column) -> DataFrame:
    """Numbers the elements at ``opens`` that lie in no other of them: ``starts`` marks them, ``block`` counts those begun
    before or here, ``inside`` tells the tokens between their tags."""
    before = Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    so_far = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__until", F.max(F.when(opens, F.col("end"))).over(before))
    rows = rows.withColumn("starts", F.coalesce(opens & (F.col("__until").isNull() | (F.col("pos") >= F.col("__until"))), F.lit(False)))
    rows = rows.withColumn("block", F.count_if("starts").over(so_far))
    inside = ~F.col("starts") & F.coalesce(F.col("pos") < F.col("__until"), F.lit(False))
    return rows.withColumn("inside", inside).drop("__until")


def _has_class(*classes: str) -> Column:
    return F.arrays_overlap("classes", F.array(*map(F.lit, classes)))


def _in_order(value: str = "token") -> Column:
    """Values of a group put together in the order of the page; a group is part of one page."""
    return F.transform(F.sort_array(F.collect_list(F.struct("pos", value))), lambda x: x[value])


def _opens(tags: Sequence[str] = (), classes: Sequence[str] = ()) -> Column:
    chosen = F.lit(False)
    if tags:
        chosen = chosen | F.col("tag").isin(*tags)
    if classes:
        chosen = chosen | _has_class(*classes)
    return F.col("end").isNotNull() & chosen


def outer_text(pages: DataFrame, key: str = "page_id", html: str = "html", tags: Sequence[str] = REVIEW_TAGS, classes: Sequence[str] = REVIEW_CLASSES, unread: Sequence[str] = UNREAD_TAGS) -> DataFrame:
    """``<key>, n_blocks, text``: texts of the outermost matching blocks of every page, one a line; what is in an ``unread``
    element is left out.  A page without blocks has an empty text.  Rows with one key each have a result."""
    rows = covered(with_elements(page_tokens(pages, key, html)), "__unread", _opens(unread))
    rows = outermost(rows, _opens(tags, classes) & ~F.col("__unread"))
    said = rows.withColumn("token", F.when(F.col("inside") & ~F.col("__unread") & is_text(F.col("token")), F.col("token")))
    blocks = said.groupBy("row", key, "block").agg(F.min("pos").alias("pos"), tx.squash(tx.decode_entities(F.array_join(_in_order(), " "))).alias("line"))
    shown = F.filter(_in_order("line"), lambda x: x != "")
    return blocks.groupBy("row", key).agg(shown.alias("lines")).select(key, F.size("lines").cast("long").alias("n_blocks"), F.array_join("lines", "\n").alias("text"))


def clean_body(pages: DataFrame, roots: Sequence[tuple[str, str | None]], drop_tags: Sequence[str] = (), drop_classes: Sequence[str] = (), repeated_classes: Sequence[str] = (), title: str | None = None, key: str = "page_id", html: str = "html") -> DataFrame:
    """``<key>, root, body``: markup of the first element of each page that matches the earliest possible of ``roots`` (tag, class or
    none), or of the whole page, without the elements to drop: by tag, by class, those of a ``repeated`` class right
    after a sibling of that class, and the first h1 if it holds ``title``.  What is left is as it was."""
    rows = with_elements(page_tokens(pages, key, html))
    page = Window.partitionBy("row").orderBy("pos")
    whole = Window.partitionBy("row")
    rank = F.lit(None).cast("int")
    for number, (tag, of) in reversed(list(enumerate(roots))):
        fits = F.col("end").isNotNull() & (F.col("tag") == tag)
        rank = F.when(fits & _has_class(of) if of else fits, number).otherwise(rank)
    span = F.struct(rank.alias("rank"), F.col("pos").alias("at"), (F.col("end") - F.when(F.col("closed"), 0).otherwise(1)).alias("upto"))
    rows = rows.withColumn("__root", F.min(F.when(rank.isNotNull(), span)).over(whole))
    rows = rows.filter("__root IS NULL OR pos IS NULL OR pos BETWEEN __root.at AND __root.upto")
    gone = _opens(drop_tags, drop_classes)
    if repeated_classes:
        # The tag before a second sibling is the end tag of the first; blank text may stand between.
        mark = F.when((F.col("tag") != "") | (is_text(F.col("token")) & (F.trim(F.col("token")) != "")), F.struct(F.col("partner").alias("of")))
        rows = rows.withColumn("__beside", F.last(mark, ignorenulls=True).over(page.rowsBetween(Window.unboundedPreceding, -1)))
        again = F.lit(False)
        for one in repeated_classes:
            again = again | (_has_class(one) & F.coalesce(F.array_contains("__beside.of", one), F.lit(False)))
        gone = gone | (F.col("end").isNotNull() & again)
    if title is not None:
        first = F.col("end").isNotNull() & (F.col("tag") == "h1")
        rows = rows.withColumn("__h1", F.min(F.when(first, F.struct("pos", "end"))).over(whole))
        within = is_text(F.col("token")) & (F.col("pos") > F.col("__h1.pos")) & (F.col("pos") < F.col("__h1.end"))
        said = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(within, F.struct("pos", "token"))).over(whole)), lambda x: x["token"]), " ")
        rows = rows.withColumn("__titled", F.contains(tx.squash(tx.decode_entities(said)), F.lit(title)))
        gone = gone | (first & (F.col("pos") == F.col("__h1.pos")) & F.col("__titled"))
    kept = covered(rows, "__gone", gone).withColumn("token", F.when(~F.col("__gone"), F.col("token")))
    named = F.coalesce(F.get(F.array(*[F.lit(tag if of is None else f"{tag}.{of}") for tag, of in roots]), F.min("__root.rank")), F.lit(""))
    return kept.groupBy("row", key).agg(named.alias("root"), F.array_join(_in_order(), "").alias("body")).drop("row")


def block_pieces(pages: DataFrame, key: str = "page_id", html: str = "html", tags: Sequence[str] = TRANSLATED_TAGS) -> DataFrame:
    """``row, <key>, block, inside, offset, length, text``: a page cut into the inner markup of its blocks to be translated
    (``inside``) and what stands between; the texts in order of the offset are the page.

    A block holds letters and no listing or table, lies in no listing, and in no other such block.
    """
    counts = {
        "barred": F.col("tag").isin(*UNTRANSLATED_INSIDE) & ~F.col("closing") | F.lower("token").rlike(r"\A<(?:script|style)\b"),
        "letters": is_text(F.col("token")) & F.col("token").rlike(LETTER),
    }
    rows = covered(with_elements(page_tokens(pages, key, html), counts=counts), "__unread", _opens(UNREAD_TAGS))
    rows = outermost(rows, _opens(tags) & ~F.col("__unread") & (F.col("barred") == 0) & (F.col("letters") > 0))
    piece = F.col("block") - F.when(F.col("starts"), 1).otherwise(0)
    size = F.char_length("token")
    offset = F.sum(size).over(Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - size
    rows = rows.select("row", key, piece.alias("block"), "inside", offset.alias("offset"), "pos", "token")
    # Without text between the tags a block has no piece, and nothing to translate.
    return rows.groupBy("row", key, "block", "inside").agg(
        F.coalesce(F.min("offset"), F.lit(0)).alias("offset"), F.array_join(_in_order(), "").alias("text")
    ).select("row", key, "block", "inside", "offset", F.char_length("text").cast("long").alias("length"), "text")


def translate_blocks(pieces: DataFrame, answers: DataFrame, key: str = "page_id") -> DataFrame:
    """Pages put together again, with ``answers(<key>, block, answer)`` in the place of the blocks they are for.

    A block without an answer, or with an empty one, keeps its source as it was.  Footnote anchors of a block stay: where the answer
    lost the token of one, the anchor follows it.  Of several answers the last by ``sequence`` counts.
    """
    best = answers.groupBy(F.col(key).alias("__key"), F.col("block").alias("__block")).agg(F.max_by("answer", "sequence").alias("__answer"))
    fits = F.col(key).eqNullSafe(F.col("__key")) & (F.col("block") == F.col("__block")) & F.col("inside")
    joined = pieces.join(best, fits, "left")
    given = F.col("inside") & (F.coalesce(F.trim("__answer"), F.lit("")) != "")
    put = F.when(given, fr.restore_footnotes(F.col("__answer"), fr.protect_footnotes(F.col("text"))["stash"])).otherwise(F.col("text"))
    done = joined.select("row", key, F.col("offset").alias("pos"), put.alias("text"), F.col("inside").alias("is_block"), given.alias("given"))
    return done.groupBy("row", key).agg(
        F.array_join(_in_order("text"), "").alias("html"), F.count_if("is_block").alias("blocks"), F.count_if("given").alias("translated")
    ).drop("row")
