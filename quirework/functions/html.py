"""HTML expressions: visible text, edges (links, images, ids), blocks, headings, code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.functions import text as tx

# --- fixed values -----------------------------------------------------------------
HIDDEN_TAGS = ("script", "style", "pre", "code", "svg", "math")
BLOCK_TAGS = ("h1", "h2", "h3", "h4", "p", "li", "caption", "blockquote")
HEADING_TAGS = ("h1", "h2", "h3", "h4", "h5", "h6")
COMMENT = r"(?is)<!--.*?-->"
ANY_TAG = r"(?is)<[^>]+>"
# ----------------------------------------------------------------------------------


def element_pattern(tags: Sequence[str], capture: bool = False) -> str:
    """Whole elements of the given tags; each tag closes itself, so no back-reference."""
    body = "(.*?)" if capture else ".*?"
    return "(?is)" + "|".join(rf"<{tag}\b[^>]*>{body}</{tag}>" for tag in tags)


HIDDEN_ELEMENT = "(?is)" + "|".join(rf"<{tag}\b.*?</{tag}>" for tag in HIDDEN_TAGS)
SCRIPT_ELEMENT = "(?is)" + "|".join(rf"<{tag}\b.*?</{tag}>" for tag in ("script", "style"))


def attribute_pattern(tag: str, name: str) -> str:
    """Value of an attribute inside a start tag, in either kind of quotes or none."""
    return (
        rf"(?is)<{tag}[\s/](?:[^>]*?[\s\"'/])?{name}\s*=\s*"
        r"(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
    )


def drop_tags(html: Column) -> Column:
    return F.regexp_replace(html, ANY_TAG, " ")


def markup_only(html: Column) -> Column:
    """Without scripts, styles and comments, whose content is not markup."""
    return F.regexp_replace(F.regexp_replace(html, SCRIPT_ELEMENT, " "), COMMENT, " ")


def visible_text(html: Column) -> Column:
    """Reader-visible text on one line; entities stay encoded."""
    value = F.regexp_replace(html, HIDDEN_ELEMENT, " ")
    return tx.squash(drop_tags(F.regexp_replace(value, COMMENT, " ")))


def node_text(fragment: Column, decode=tx.decode_entities) -> Column:
    """Text of a fragment: tags to blanks, entities decoded, white space collapsed."""
    text = drop_tags(fragment)
    # Most fragments hold no entity, and one search for its first character is cheaper than one for each.
    return tx.squash(F.when(F.contains(fragment, F.lit("&")), decode(text)).otherwise(text))


def attribute_values(html: Column, tag: str, name: str) -> Column:
    """Non-empty attribute values in document order, quotes removed and entities decoded."""
    return attribute_values_any(markup_only(html), tag, name)


def attribute_values_any(html: Column, tag: str, name: str) -> Column:
    """The same over raw markup, script and style tags included."""
    found = F.regexp_extract_all(html, F.lit(attribute_pattern(tag, name)), F.lit(1))
    bare = F.transform(found, lambda v: tx.decode_entities(F.regexp_replace(v, r"\A[\"']|[\"']\z", "")))
    return F.filter(bare, lambda v: v != "")


def links(html: Column) -> Column:
    return attribute_values(html, "a", "href")


def images(html: Column) -> Column:
    return attribute_values(html, "img", "src")


def ids(html: Column) -> Column:
    return F.array_distinct(attribute_values(html, "[a-z][a-z0-9]*", "id"))


def elements(html: Column, tags: Sequence[str]) -> Column:
    """Whole elements in document order (an element nested in another match is part of it)."""
    return F.regexp_extract_all(html, F.lit(element_pattern(tags)), F.lit(0))


#: An exercise of a page, up to its first end tag.
EXERCISE = r"(?is)<(div|span)\b(?=[^>]*\bclass\s*=\s*[\"'](?:[^\"']*\s)?exercise(?:\s[^\"']*)?[\"'])[^>]*>.*?</\1\s*>"


def visible_blocks(html: Column, tags: Sequence[str] = BLOCK_TAGS) -> Column:
    """Non-empty texts of the block elements, then of the exercises; formulas removed."""
    shown = F.regexp_replace(F.regexp_replace(html, HIDDEN_ELEMENT, " "), COMMENT, " ")
    exercises = F.regexp_extract_all(shown, F.lit(EXERCISE), F.lit(0))
    texts = F.transform(F.concat(elements(shown, tags), exercises), lambda e: tx.strip_latex(node_text(e)))
    return F.filter(texts, lambda t: t != "")


def first_element_text(html: Column, tag: str) -> Column:
    return node_text(F.regexp_extract(markup_only(html), element_pattern([tag], capture=True), 1))


def headings(html: Column, tags: Sequence[str] = HEADING_TAGS) -> Column:
    """Array of (level, id, text) in document order."""
    found = elements(markup_only(html), tags)
    return F.transform(
        found,
        lambda e: F.struct(
            F.regexp_extract(e, r"(?is)\A<h([1-6])", 1).cast("int").alias("level"),
            F.nullif(
                F.regexp_extract(e, r"(?is)\A<h[1-6](?:\s[^>]*?)?\sid\s*=\s*[\"']([^\"']+)[\"']", 1), F.lit("")
            ).alias("id"),
            node_text(e).alias("text"),
        ),
    )


def article_toc(html: Column, minimum: int = 3) -> Column:
    """Second- and third-level headings as (anchor, text, nested); empty below ``minimum``.
    A heading without an id is given its 1-based position."""
    found = headings(html, ("h2", "h3"))
    entries = F.transform(
        found,
        lambda h, i: F.struct(
            F.coalesce(h["id"], F.concat(F.lit("section-"), (i + 1).cast("string"))).alias("anchor"),
            h["text"].alias("text"),
            (h["level"] == 3).alias("nested"),
        ),
    )
    return F.when(F.size(found) >= minimum, entries).otherwise(F.slice(entries, 1, 0))


def code_blocks(html: Column) -> Column:
    """Array of (classes, text) of the code elements."""
    found = F.regexp_extract_all(markup_only(html), F.lit(r"(?is)<code\b[^>]*>.*?</code>"), F.lit(0))
    return F.transform(
        found,
        lambda e: F.struct(
            F.regexp_extract(e, r"(?is)\A<code\s(?:[^>]*?\s)?class\s*=\s*[\"']([^\"']*)[\"']", 1).alias("classes"),
            tx.decode_entities(F.regexp_replace(e, ANY_TAG, "")).alias("text"),
        ),
    )


def code_in_language(html: Column, language: str) -> Column:
    """Texts of the code elements carrying the class ``language-<language>``."""
    wanted = f"language-{language}"
    chosen = F.filter(
        code_blocks(html), lambda c: F.array_contains(F.split(c["classes"], r"\s+"), wanted)
    )
    return F.transform(chosen, lambda c: c["text"])


def restrict_images(fragment: Column, prefixes: Sequence[str]) -> Column:
    """Drop image tags whose source does not start with an approved prefix."""
    allowed = "|".join(rf"\Q{p}\E" for p in prefixes)
    pattern = rf"(?is)<img\b(?![^>]*\bsrc\s*=\s*[\"'](?:{allowed}))[^>]*>"
    return F.regexp_replace(fragment, pattern, "")


def namespace_footnotes(fragment: Column, page: Column) -> Column:
    """``fn1`` / ``fnref1`` become page-qualified in both ids and references."""
    tag = F.concat(F.lit("p"), F.lpad(page.cast("string"), 3, "0"))
    tag = F.when(page >= 1000, F.concat(F.lit("p"), page.cast("string"))).otherwise(tag)
    marked = tx.rewrite_all(
        fragment,
        [
            (r"(\bid\s*=\s*)([\"'])(fnref|fn)(\d+)\2", "$1$2$3-\u0001-$4$2"),
            (r"(\bhref\s*=\s*)([\"'])#(fnref|fn)(\d+)\2", "$1$2#$3-\u0001-$4$2"),
        ],
    )
    return F.replace(marked, F.lit("\u0001"), tag)


def ensure_section(fragment: Column, page: Column) -> Column:
    """Wrap a fragment in its page section unless it has one already."""
    has = fragment.rlike(r"<section\b[^>]*class=[\"'][^\"']*\bbook-page\b")
    wrapped = F.concat(
        F.lit('<section class="book-page" data-pdf-page="'), page.cast("string"), F.lit('">\n'), fragment, F.lit("\n</section>")
    )
    return F.when(has, fragment).otherwise(wrapped)


def insert_anchors(fragment: Column, slugs: Column) -> Column:
    """Put an empty anchor in front for each slug the fragment does not define yet."""
    missing = F.filter(
        slugs,
        lambda s: (s != "")
        & ~(F.contains(fragment, F.concat(F.lit('id="'), s, F.lit('"'))) | F.contains(fragment, F.concat(F.lit("id='"), s, F.lit("'")))),
    )
    spans = F.transform(
        missing, lambda s: F.concat(F.lit('<span class="section-anchor" id="'), tx.escape_html(s), F.lit('"></span>'))
    )
    return F.when(F.size(missing) > 0, F.concat(F.array_join(spans, "\n"), F.lit("\n"), fragment)).otherwise(fragment)


def unwrap_placeholders(fragment: Column) -> Column:
    """Code-pair placeholders and figures leave the paragraph or code that wraps them."""
    return tx.rewrite_all(
        fragment,
        [
            (r"<pre><code(?:\s+class=[\"'][^\"']*[\"'])?>\s*(\[\[CODE_PAIR:[^\]]+\]\])\s*</code></pre>", "$1"),
            (r"<p>\s*(\[\[CODE_PAIR:[^\]]+\]\])\s*</p>", "$1"),
            (r"<p>\s*(<figure\b)", "$1"),
            (r"(</figure>)\s*</p>", "$1"),
        ],
    )


def repair_doctype(html: Column) -> Column:
    """No byte-order mark, a doctype in front of the root element, normalized lines."""
    value = F.regexp_replace(html, "\\A\ufeff+", "")
    value = F.regexp_replace(value, r"(?i)\Ahtml\s*\n(?=<html\b)", "<!doctype html>\n")
    value = F.when(value.rlike(r"(?i)\A<html\b"), F.concat(F.lit("<!doctype html>\n"), value)).otherwise(value)
    return tx.normalize_lines(value)


def bad_preamble(html: Column) -> Column:
    """The first line is a bare ``html`` or the root element instead of a doctype."""
    first = F.lower(tx.strip(F.regexp_extract(html, r"\A([^\n\r]*)", 1)))
    return (first == "html") | first.startswith("<html")


def paragraphs(text: Column) -> Column:
    """Blank-line separated chunks as paragraphs; a chunk of ``- `` lines becomes a list."""
    chunks = F.filter(
        F.transform(F.split(tx.strip(text), rf"\n{tx.SPACE}*\n"), tx.strip), lambda c: c != ""
    )

    def markup(rows: Column) -> Column:
        items = F.transform(
            rows,
            lambda r: F.concat(F.lit("<li>"), tx.escape_html(tx.strip(F.substr(r, F.lit(3)))), F.lit("</li>")),
        )
        listed = F.concat(F.lit("<ul>"), F.array_join(items, ""), F.lit("</ul>"))
        plain = F.concat(F.lit("<p>"), tx.escape_html(F.array_join(rows, " ")), F.lit("</p>"))
        return F.when(F.forall(rows, lambda r: r.startswith("- ")), listed).otherwise(plain)

    def render(chunk: Column) -> Column:
        return tx.bind(F.filter(F.transform(tx.lines(chunk), tx.strip), lambda r: r != ""), markup)

    return F.array_join(F.transform(chunks, render), "\n")


_SECTION_START = r"<div\b(?=[^>]*\bclass\s*=\s*[\"'][^\"']*\bsection\b)[^>]*>\s*"


def _attribute(tag: Column, name: str) -> Column:
    return F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*[\"']([^\"']*)[\"']", 1)


def section_links(html: Column) -> Column:
    """Array of (anchor, label) of the second-level headings: their own id, or the id of the
    section they open; a section's number goes in front of a label that lacks it."""

    found = F.regexp_extract_all(html, F.lit(rf"(?is)(?:{_SECTION_START})?<h2\b[^>]*>.*?</h2>"), F.lit(0))

    def read(piece: Column) -> Column:
        wrap = F.regexp_extract(piece, r"(?is)\A(<div\b[^>]*>)", 1)
        head = F.regexp_extract(piece, r"(?is)(<h2\b[^>]*>)", 1)
        own = _attribute(head, "id")
        label = node_text(F.regexp_replace(piece, r"(?is)\A<div\b[^>]*>", ""))
        number = F.when(own == "", tx.strip(_attribute(wrap, "number"))).otherwise(F.lit(""))
        numbered = F.when((number != "") & ~label.startswith(number), F.concat(number, F.lit(" "), label)).otherwise(label)
        return F.struct(F.when(own != "", own).otherwise(_attribute(wrap, "id")).alias("anchor"), numbered.alias("label"))

    return F.filter(F.transform(found, read), lambda s: (s["anchor"] != "") & (s["label"] != ""))


def number_sections(html: Column) -> Column:
    """Headings of numbered sections ("2.1") get their number where it is missing."""
    from quirework.functions import fragments as fr
    from quirework.functions import titles

    pattern = rf"(?is){_SECTION_START}<h[2-6]\b[^>]*>.*?</h[2-6]>"

    def mend(piece: Column) -> Column:
        number = tx.strip(_attribute(F.regexp_extract(piece, r"(?is)\A(<div\b[^>]*>)", 1), "number"))
        label = node_text(F.regexp_replace(piece, r"(?is)\A<div\b[^>]*>", ""))
        wanted = F.contains(number, F.lit(".")) & (label != "") & ~titles.number_heads_label(label, number)
        opening = F.regexp_extract(piece, r"(?is)\A(<div\b[^>]*>\s*<h[2-6]\b[^>]*>)", 1)
        closing = F.regexp_extract(piece, r"(?is)(</h[2-6]>)\z", 1)
        return F.when(wanted, F.concat(opening, number, F.lit(" "), tx.escape_html(label), closing)).otherwise(piece)

    return fr.stitch(F.split(html, pattern), F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(0)), mend))
