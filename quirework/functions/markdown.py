"""Front matter and a small Markdown dialect, as expressions over whole documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.functions import text as tx

FRONT_MARK = "---\n"
#: Lines per stretch of the fold over a document.
STRETCH = 512


def has_front_matter(raw: Column) -> Column:
    return raw.startswith(FRONT_MARK) & (F.size(F.split(raw, FRONT_MARK, 3)) >= 3)


def unquote(value: Column) -> Column:
    return F.regexp_replace(tx.strip(value), r"\A[\"']+|[\"']+\z", "")


def front_matter(raw: Column) -> Column:
    """Map of the raw front-matter values; comment and blank lines ignored, last key wins."""
    rows = F.filter(
        tx.lines(F.coalesce(F.get(F.split(raw, FRONT_MARK, 3), F.lit(1)), F.lit(""))),
        lambda r: (tx.strip(r) != "") & ~tx.strip(r).startswith("#"),
    )
    pairs = F.transform(
        rows,
        lambda r: F.struct(
            tx.strip(F.substring_index(r, ":", 1)).alias("key"),
            tx.strip(F.when(F.contains(r, F.lit(":")), F.regexp_replace(r, r"\A[^:]*:", "")).otherwise(F.lit(""))).alias("value"),
        ),
    )
    last = F.filter(
        pairs,
        lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["key"] == p["key"]),
    )
    return F.map_from_entries(last)


def body(raw: Column) -> Column:
    return tx.strip(F.coalesce(F.get(F.split(raw, FRONT_MARK, 3), F.lit(2)), F.lit("")))


def is_list_value(value: Column, commas: bool) -> Column:
    bracketed = value.startswith("[") & value.endswith("]")
    if not commas:
        return bracketed
    address = value.startswith("http://") | value.startswith("https://") | value.startswith("/")
    return bracketed | (value.contains(",") & ~address)


def list_value(value: Column) -> Column:
    """Items of a bracketed or comma-separated value."""
    inner = F.when(
        value.startswith("[") & value.endswith("]"), F.regexp_replace(value, r"\A\[|\]\z", "")
    ).otherwise(value)
    items = F.filter(F.split(inner, ","), lambda i: tx.strip(i) != "")
    return F.transform(items, unquote)


def scalar_value(value: Column, commas: bool) -> Column:
    """A scalar; with ``commas`` a value holding a comma reads as a list and prints as one."""
    shown = F.concat(
        F.lit("["),
        F.array_join(F.transform(list_value(value), lambda i: F.concat(F.lit("'"), i, F.lit("'"))), ", "),
        F.lit("]"),
    )
    return F.when(is_list_value(value, commas), shown).otherwise(unquote(value))


def inline(text: Column) -> Column:
    """Escaped text with code, strong, emphasis and links, in that order."""
    return tx.rewrite_all(
        tx.escape_html(text),
        [
            (r"`([^`]+)`", "<code>$1</code>"),
            (r"\*\*([^*]+)\*\*", "<strong>$1</strong>"),
            (r"\*([^*]+)\*", "<em>$1</em>"),
            (r"\[([^\]]+)\]\(([^)]+)\)", '<a href="$2">$1</a>'),
        ],
    )


def render(markdown: Column) -> Column:
    """HTML of a document.

    Each line is classified once; a fold over the lines keeps what is open (the lines of a paragraph or
    of code, the list) and appends finished blocks, by stretches of lines, so that appending copies no more
    than a stretch.  A fence that never closes is dropped with
    its lines, as are lines after it.
    """
    fence, blank, figure, heading, quote, bullet, number, plain = range(8)
    image = r"\A!\[([^\]]*)\]\(([^)]+)\)\z"

    def classify(raw: Column) -> Column:
        row = F.regexp_replace(raw, rf"{tx.SPACE}+\z", "")
        kind = (
            F.when(row == "", blank)
            .when(~row.rlike(r"\A[`!#>*\-0-9]"), plain)
            .when(row.startswith("```"), fence)
            .when(row.rlike(image), figure)
            .when(row.rlike(rf"\A#{{1,4}}{tx.SPACE}+.+\z"), heading)
            .when(row.rlike(rf"\A>{tx.SPACE}+.+\z"), quote)
            .when(row.rlike(rf"\A[-*]{tx.SPACE}+.+\z"), bullet)
            .when(row.rlike(rf"\A\d+\.{tx.SPACE}+.+\z"), number)
            .otherwise(plain)
        )
        return F.struct(row.alias("row"), kind.alias("kind"))

    def dress(line: Column) -> Column:
        row, kind = line["row"], line["kind"]
        level = F.length(F.regexp_extract(row, rf"\A(#{{1,4}}){tx.SPACE}", 1)).cast("string")
        alt = F.regexp_extract(tx.escape_html(row), image, 1)
        src = F.regexp_extract(tx.escape_html(row), image, 2)
        item = F.regexp_replace(row, rf"\A(?:[-*]|\d+\.|>|#{{1,4}}){tx.SPACE}+", "")
        block = (
            F.when(kind.isin(plain, blank, fence), F.lit(""))
            .when(
                kind == figure,
                F.concat(
                    F.lit('<figure class="article-figure"><img src="'), src, F.lit('" alt="'), alt,
                    F.lit('" loading="lazy"></figure>'),
                ),
            )
            .when(kind == heading, F.concat(F.lit("<h"), level, F.lit(">"), inline(item), F.lit("</h"), level, F.lit(">")))
            .when(kind == quote, F.concat(F.lit("<blockquote>"), inline(item), F.lit("</blockquote>")))
            .otherwise(F.concat(F.lit("<li>"), inline(item), F.lit("</li>")))
        )
        return F.struct(row.alias("row"), kind.alias("kind"), block.alias("block"))

    def state(out: Column, para: Column, listed: Column, code: Column) -> Column:
        """``para`` and ``code`` are NULL while closed; ``listed`` names the open list."""
        return F.struct(out.alias("out"), para.alias("para"), listed.alias("listed"), code.alias("code"))

    none = F.lit(None).cast("string")
    shut = F.lit(None).cast("array<string>")
    empty = F.array().cast("array<string>")

    def closed_para(s: Column) -> Column:
        shown = F.concat(F.lit("<p>"), inline(F.array_join(s["para"], " ")), F.lit("</p>\n"))
        return F.when(s["para"].isNotNull(), F.concat(s["out"], F.array(shown))).otherwise(s["out"])

    def closed_all(s: Column) -> Column:
        tail = F.when(s["listed"].isNotNull(), F.concat(F.lit("</"), s["listed"], F.lit(">\n"))).otherwise(F.lit(""))
        return F.concat(closed_para(s), F.array(tail))

    def add(s: Column, line: Column) -> Column:
        kind, row = line["kind"], line["row"]
        wanted = F.when(kind == bullet, F.lit("ul")).otherwise(F.lit("ol"))
        same = F.coalesce(s["listed"] == wanted, F.lit(False))
        opened = F.concat(
            F.when(same, F.lit("")).otherwise(
                F.concat(
                    F.when(s["listed"].isNotNull(), F.concat(F.lit("</"), s["listed"], F.lit(">\n"))).otherwise(F.lit("")),
                    F.lit("<"), wanted, F.lit(">\n"),
                )
            ),
        )
        in_code = s["code"].isNotNull()
        listing = F.concat(F.lit("<pre><code>"), tx.escape_html(F.array_join(s["code"], "\n")), F.lit("</code></pre>\n"))
        return (
            F.when(in_code & (kind == fence), state(F.concat(s["out"], F.array(listing)), s["para"], s["listed"], shut))
            .when(in_code, state(s["out"], s["para"], s["listed"], F.concat(s["code"], F.array(row))))
            .when(kind == fence, state(closed_all(s), shut, none, empty))
            .when(kind == blank, state(closed_all(s), shut, none, shut))
            .when(kind.isin(figure, heading, quote), state(F.concat(closed_all(s), F.array(line["block"], F.lit("\n"))), shut, none, shut))
            .when(kind.isin(bullet, number), state(F.concat(closed_para(s), F.array(opened, line["block"], F.lit("\n"))), shut, wanted, shut))
            .otherwise(
                state(
                    s["out"],
                    F.concat(F.coalesce(s["para"], empty), F.array(tx.strip(row))),
                    s["listed"],
                    shut,
                )
            )
        )

    def over(s: Column, stretch: Column) -> Column:
        walked = F.aggregate(stretch, state(empty, s["para"], s["listed"], s["code"]), add)
        return tx.bind(walked, lambda w: state(F.concat(s["out"], F.array(w["out"])), w["para"], w["listed"], w["code"]))

    def whole(s: Column) -> Column:
        return F.array_join(closed_all(state(F.flatten(s["out"]), s["para"], s["listed"], s["code"])), "")

    def walk(rows: Column) -> Column:
        stretches = F.transform(
            F.sequence(F.lit(0), F.floor(F.greatest(F.size(rows) - 1, F.lit(0)) / STRETCH).cast("int")),
            lambda n: F.slice(rows, n * STRETCH + 1, F.lit(STRETCH)),
        )
        return F.aggregate(stretches, state(F.array().cast("array<array<string>>"), shut, none, shut), over, whole)

    folded = tx.bind(F.transform(F.transform(tx.lines(markdown), classify), dress), walk)
    return F.regexp_replace(folded, r"\n\z", "")
