"""Page fragments: boilerplate, headings, images, embedded blocks, links."""

from __future__ import annotations

import html
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.functions import html as hx
from quirework.functions import rules as rx
from quirework.functions import text as tx
from quirework.functions import titles


#: Lines per stretch of a fold.
STRETCH = 512


def stitch(parts: Column, values: Column) -> Column:
    """Text pieces with a value after each but the last."""
    return F.array_join(F.transform(parts, lambda part, i: F.concat(part, F.coalesce(F.get(values, i), F.lit("")))), "")


def drop_boilerplate(
    text: Column,
    notices: Sequence[tuple[str, int]] = (),
    openings: Sequence[tuple[str, int]] = (),
    dropped: Sequence[str] = (),
    prefixes: Sequence[str] = (),
) -> Column:
    """Source text without notices, running headers and page numbers.

    ``notices`` (contained) and ``openings`` (leading) take the given number of following
    lines with them; ``dropped`` and ``prefixes`` name single lines.  A page number stays
    only as the first line kept.  All markers are lower case.
    """
    kept = _kept_lines(text, notices, openings, dropped, prefixes)
    return F.array_join(F.transform(kept, lambda s: s["raw"]), "\n")


def _kept_lines(
    text: Column,
    notices: Sequence[tuple[str, int]] = (),
    openings: Sequence[tuple[str, int]] = (),
    dropped: Sequence[str] = (),
    prefixes: Sequence[str] = (),
) -> Column:
    """The lines ``drop_boilerplate`` keeps, each as it was (``raw``) and squashed (``line``)."""

    def pair(line: Column) -> Column:
        return F.struct(line["raw"].alias("raw"), line["line"].alias("line"))

    def look(raw: Column) -> Column:
        def judge(s: Column) -> Column:
            low = s["low"]
            skip = F.lit(0)
            for mark, count in reversed(list(openings)):
                skip = F.when(low.startswith(mark), F.lit(count)).otherwise(skip)
            for mark, count in reversed(list(notices)):
                skip = F.when(low.contains(mark), F.lit(count)).otherwise(skip)
            lone = F.lit(False)
            for mark in prefixes:
                lone = lone | low.startswith(mark)
            if dropped:
                lone = lone | low.isin(*dropped)
            return F.struct(
                s["raw"].alias("raw"),
                s["line"].alias("line"),
                skip.alias("skip"),
                (lone | rx.is_source_header(s["line"])).alias("lone"),
                s["line"].rlike(r"\A[0-9]{1,4}\z").alias("number"),
            )

        return tx.bind(tx.squash(raw), lambda line: tx.bind(F.struct(raw.alias("raw"), line.alias("line"), F.lower(line).alias("low")), judge))

    looked = F.transform(tx.lines(text), look)
    if not notices and not openings:
        # Each line stands for itself, but for a page number behind the first one kept.
        stay = F.filter(looked, lambda line: ~line["lone"])
        return F.transform(F.filter(stay, lambda line, i: (i == 0) | ~line["number"]), pair)

    def state(out: Column, left: Column, some: Column) -> Column:
        return F.struct(out.alias("out"), left.alias("left"), some.alias("some"))

    def step(s: Column, line: Column) -> Column:
        return (
            F.when(s["left"] > 0, state(s["out"], s["left"] - 1, s["some"]))
            .when(line["skip"] > 0, state(s["out"], line["skip"], s["some"]))
            .when(line["lone"] | (line["number"] & s["some"]), s)
            .otherwise(state(F.concat(s["out"], F.array(pair(line))), F.lit(0), F.lit(True)))
        )

    none = F.array().cast("array<struct<raw:string,line:string>>")

    # The lines kept are gathered by stretch, so that appending copies at most a stretch, not all lines before.
    def over(s: Column, stretch: Column) -> Column:
        walked = F.aggregate(stretch, state(none, s["left"], s["some"]), step)
        return tx.bind(walked, lambda w: state(F.concat(s["out"], F.array(w["out"])), w["left"], w["some"]))

    def kept(looked: Column) -> Column:
        stretches = F.transform(
            F.sequence(F.lit(0), F.floor(F.greatest(F.size(looked) - 1, F.lit(0)) / STRETCH).cast("int")),
            lambda n: F.slice(looked, n * STRETCH + 1, F.lit(STRETCH)),
        )
        start = state(F.array().cast("array<array<struct<raw:string,line:string>>>"), F.lit(0), F.lit(False))
        return F.aggregate(stretches, start, over, lambda s: F.flatten(s["out"]))

    return tx.bind(looked, kept)


def drop_elements(fragment: Column, tags: Sequence[str], unwanted) -> Column:
    """Remove the elements whose text satisfies ``unwanted`` (a Column predicate)."""
    pattern = hx.element_pattern(tags)
    found = F.regexp_extract_all(fragment, F.lit(pattern), F.lit(0))
    kept = F.transform(found, lambda e: F.when(unwanted(hx.node_text(e)), F.lit("")).otherwise(e))
    return stitch(F.split(fragment, pattern), kept)


def drop_header_elements(fragment: Column) -> Column:
    """Headings and paragraphs that are left-over running headers."""
    return drop_elements(fragment, (*hx.HEADING_TAGS, "p"), rx.is_rendered_header)


def drop_visible_boilerplate(fragment: Column, marks: Sequence[str]) -> Column:
    """Paragraphs holding a publisher's mark (a pattern) or nothing but a page number."""
    held = "|".join(marks)
    value = F.regexp_replace(fragment, r"(?i)<p[^>]*>\s*[0-9]{1,4}\s*</p>", "")
    return F.regexp_replace(value, rf"(?i)<p[^>]*>[^<]*(?:{held})[^<]*</p>", "") if held else value


def source_lines(text: Column, **boilerplate) -> Column:
    rows = F.filter(_kept_lines(text, **boilerplate), lambda s: s["line"] != "")
    return F.transform(rows, lambda s: s["line"])


def title_position(lines: Column, title: Column) -> Column:
    """1-based line that reads like the title, 0 if none does."""

    def found(form: Column) -> Column:
        return F.when(form == "", F.lit(0)).otherwise(F.array_position(F.transform(lines, titles.canonical_heading), form)).cast("int")

    return tx.bind(titles.canonical_heading(title), found)


def title_near_top(lines: Column, title: Column, at: Column | None = None) -> Column:
    """The title is absent, first, or preceded by up to three chapter-opening lines only.  ``at`` is its position, where known."""
    from quirework.operators.layout import is_opening_line

    at = title_position(lines, title) if at is None else at
    opened = F.forall(F.slice(lines, F.lit(1), F.greatest(at - 1, F.lit(0))), is_opening_line)
    return (at <= 1) | ((at <= 4) & opened)


def prose_blocks_before(lines: Column, title: Column, at: Column | None = None) -> Column:
    """Stretches of prose lines above the title.  ``at`` is its position, where known."""
    from quirework.operators.layout import is_prose_line

    above = F.slice(lines, F.lit(1), F.greatest((title_position(lines, title) if at is None else at) - 1, F.lit(0)))

    def begun(flags: Column) -> Column:
        return F.size(F.filter(F.transform(flags, lambda f, i: f & ~F.coalesce(F.get(flags, i - 1), F.lit(False))), lambda f: f))

    # Each line is judged once, not anew for each line after it.
    return tx.bind(F.transform(above, is_prose_line), begun)


_LEADING = (
    r"(?is)\A(<section\b[^>]*>\s*)(?:"
    + "|".join(rf"<{t}\b[^>]*>.*?</{t}>" for t in (*hx.HEADING_TAGS, "p"))
    + ")"
)


def leading_text(fragment: Column) -> Column:
    """Text of the first heading or paragraph of a page section."""
    return hx.node_text(F.regexp_replace(F.regexp_extract(fragment, _LEADING, 0), r"(?is)\A<section\b[^>]*>", ""))


def drop_leading(fragment: Column) -> Column:
    return F.regexp_replace(fragment, _LEADING, "$1")


def insert_after_prose(fragment: Column, heading: Column, blocks: Column, after_figure: Column) -> Column:
    """Put a heading in front of paragraph ``blocks`` (from 0); behind the last figure if
    ``after_figure`` and none precede; else at the end of the section."""

    def put(pieces: Column) -> Column:
        # Without a lead the first piece is itself a paragraph.
        lead = F.when(F.get(pieces, F.lit(0)).rlike(r"(?i)\A<p\b"), F.lit(0)).otherwise(F.lit(1))
        cut = blocks + lead
        placed = F.concat(
            F.array_join(F.slice(pieces, F.lit(1), cut), ""), heading, F.lit("\n"), F.array_join(F.slice(pieces, cut + 1, F.size(pieces)), "")
        )
        return F.when(cut < F.size(pieces), placed).otherwise(ended)

    closed = fragment.rlike(r"(?i)</section>\s*\z")
    ended = F.when(closed, F.regexp_replace(fragment, F.lit(r"(?i)(</section>\s*)\z"), F.concat(F.lit("\n"), _literal(heading), F.lit("\n$1")))).otherwise(
        F.concat(fragment, F.lit("\n"), heading)
    )
    figure = after_figure & (blocks == 0) & fragment.rlike("(?i)</figure>")
    behind = F.regexp_replace(fragment, F.lit(r"(?is)\A(.*</figure>)"), F.concat(F.lit("$1\n"), _literal(heading)))
    return F.when(figure, behind).otherwise(tx.bind(F.split(fragment, r"(?i)(?=<p\b)"), put))


def settle_heading(
    fragment: Column, page: Column, section_page: Column, near_top: Column, heading: Column, blocks: Column, after_figure: Column
) -> Column:
    """A page led by a section title (``section_page`` is NULL if it is not): a section of an
    earlier page loses the title; one that starts lower on this page gets it moved there."""
    bare = drop_leading(fragment)
    return (
        F.when(section_page.isNull() | (section_page > page), fragment)
        .when(section_page < page, bare)
        .when(near_top, fragment)
        .otherwise(tx.bind(bare, lambda rest: insert_after_prose(rest, heading, blocks, after_figure)))
    )


def section_heading(level: Column, slug: Column, title: Column) -> Column:
    rank = F.least(F.lit(6), F.greatest(F.lit(2), F.coalesce(level, F.lit(1)) + 1)).cast("string")
    return F.concat(F.lit("<h"), rank, F.lit(' id="'), tx.escape_html(slug), F.lit('">'), tx.escape_html(title), F.lit("</h"), rank, F.lit(">"))


def _literal(replacement: Column) -> Column:
    """Text as a regular-expression replacement that means itself."""
    return F.replace(F.replace(replacement, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))


def add_images(fragment: Column, images: Column) -> Column:
    """Figures for the images (src, number, caption) the fragment does not show yet, at the
    end of its section."""
    def figure(im: Column) -> Column:
        number = F.coalesce(im["number"], F.lit(""))
        anchor = F.when(number != "", F.concat(F.lit(' id="fig-'), tx.escape_html(number), F.lit('"'))).otherwise(F.lit(""))
        caption = tx.escape_html(F.coalesce(im["caption"], F.lit("")))
        return F.concat(
            F.lit('<figure class="book-figure"'), anchor, F.lit('><img src="'), tx.escape_html(im["src"]), F.lit('" alt="'), caption,
            F.lit('" loading="lazy"><figcaption>'), caption, F.lit("</figcaption></figure>"),
        )

    absent = F.filter(images, lambda im: (F.coalesce(im["src"], F.lit("")) != "") & ~F.contains(fragment, im["src"]))
    added = F.array_join(F.transform(absent, figure), "\n")
    inside = F.regexp_replace(fragment, F.lit(r"(</section>\s*)\z"), F.concat(F.lit("\n"), _literal(added), F.lit("\n$1")))
    return (
        F.when(F.coalesce(F.size(absent), F.lit(0)) <= 0, fragment)
        .when(fragment.rlike(r"</section>\s*\z"), inside)
        .otherwise(F.concat(fragment, F.lit("\n"), added))
    )


def add_figure_ids(fragment: Column, images: Column) -> Column:
    """``id="fig-<number>"`` on book figures that show a numbered image and have no id."""
    def step(done: Column, im: Column) -> Column:
        name = F.concat(F.lit("fig-"), im["number"])
        taken = F.contains(done, F.concat(F.lit('id="'), name, F.lit('"'))) | F.contains(done, F.concat(F.lit("id='"), name, F.lit("'")))
        source = F.concat(F.lit("\\Q"), tx.escape_html(im["src"]), F.lit("\\E"))
        pattern = F.concat(
            F.lit(r"<figure\b(?![^>]*\bid=)(?=[^>]*class=[\"'][^\"']*\bbook-figure\b)[^>]*>(\s*<img\b[^>]*src=[\"']"), source, F.lit("[\"'])")
        )
        known = (F.coalesce(im["src"], F.lit("")) != "") & (F.coalesce(im["number"], F.lit("")) != "")
        opened = F.concat(F.lit('<figure class="book-figure" id="'), _literal(tx.escape_html(name)), F.lit('">$1'))
        return F.when(known & ~taken, F.regexp_replace(done, pattern, opened)).otherwise(done)

    return F.aggregate(images, fragment, step)


@F.pandas_udf(T.StringType())
def lift_code_tabs(fragment: pd.Series) -> pd.Series:
    """Tab blocks that ended up inside ``pre``/``code`` come out again; text after them stays
    as a listing of its own.  Finding a block's end means counting nested tags."""
    opener = re.compile(r'<pre><code[^>]*>\s*(?=<div class="code-tabs")')
    division = re.compile(r"<(/?)div\b[^>]*>", re.IGNORECASE)
    closer = re.compile(r"\s*</code>\s*</pre>", re.IGNORECASE)

    def block_end(text: str, at: int) -> int:
        depth = 0
        for tag in division.finditer(text, at):
            depth += -1 if tag.group(1) else 1
            if depth == 0:
                return tag.end()
        return -1

    def lift(text: str) -> str:
        done, at = [], 0
        while (found := opener.search(text, at)) is not None:
            end = block_end(text, found.end())
            close = closer.search(text, end) if end >= 0 else None
            if close is None:
                done.append(text[at : found.end()])
                at = found.end()
                continue
            rest = text[end : close.start()].strip()
            listing = f'\n<pre><code class="language-text">{html.escape(rest)}</code></pre>' if rest else ""
            done += [text[at : found.start()], text[found.end() : end], listing]
            at = close.end()
        return "".join([*done, text[at:]])

    return fragment.map(lift, na_action="ignore")


def unescape_attributes(fragment: Column) -> Column:
    """Backslash-escaped quotes of a generated fragment become plain ones."""
    return F.replace(F.replace(fragment, F.lit("\\'"), F.lit("'")), F.lit('\\"'), F.lit('"'))


def single_math_marks(text: Column) -> Column:
    """Doubled backslashes of formula marks become single."""
    return tx.replace_all(text, [(r"\\(", r"\("), (r"\\)", r"\)"), (r"\\[", r"\["), (r"\\]", r"\]")])


def number_labels(text: Column, words: Sequence[tuple[str, str]]) -> Column:
    """Translated label words in front of a number ("Figure 3")."""
    return tx.rewrite_all(text, [(rf"\b\Q{old}\E(?=[0-9])", new) for old, new in words])


def protect_footnotes(fragment: Column) -> Column:
    """(text, stash): footnote anchors replaced by tokens and kept aside."""
    pattern = r"(?is)<a\b(?=[^>]*\bclass\s*=\s*[\"'][^\"']*\bfootnote-(?:ref|back)\b)[^>]*>.*?</a>"
    anchors = F.regexp_extract_all(fragment, F.lit(pattern), F.lit(0))
    tokens = F.transform(anchors, lambda _, i: F.format_string("FOOTNOTEANCHOR%03d", i))
    return F.struct(stitch(F.split(fragment, pattern), tokens).alias("text"), anchors.alias("stash"))


def restore_footnotes(text: Column, stash: Column) -> Column:
    """Anchors back in place of their tokens; a token that was lost has its anchor appended."""
    marked = F.transform(stash, lambda a, i: F.struct(F.format_string("FOOTNOTEANCHOR%03d", i).alias("token"), a.alias("anchor")))
    return F.aggregate(
        marked,
        text,
        lambda done, m: F.when(F.contains(done, m["token"]), F.replace(done, m["token"], m["anchor"])).otherwise(F.concat(done, m["anchor"])),
    )


def data_uri(content: Column, kind: str = "image/png") -> Column:
    return F.concat(F.lit(f"data:{kind};base64,"), F.base64(content))
