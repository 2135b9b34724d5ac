"""Text expressions.  Patterns avoid look-behind and back-references where a query is
checked against SQL, and spell out white space instead of relying on an engine's ``\\s``."""

from __future__ import annotations

import html
from collections.abc import Callable, Iterable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------
# White space that ends a word, without and with the line feed.
BLANK_CHARS = r"\t\r\f\x{b}\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BLANK = f"[{BLANK_CHARS}]"
SPACE = rf"[\n{BLANK_CHARS}]"
# The same white space as plain characters, and without the blank, for the fast paths below.
SPACE_CHARS = (
    "\n\t\r\f\x0b\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
OTHER_SPACE = f"[\\n{BLANK_CHARS.replace(' ', '')}]"
LINE_BREAK = r"\r\n|[\r\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
CJK = r"[\x{4e00}-\x{9fff}]"
LATIN = "[A-Za-z]"
READING_UNIT = r"[\x{4e00}-\x{9fff}]|[A-Za-z0-9]+"
MARKDOWN_PUNCTUATION = r"[#>*`\-\[\]().]"
UNITS_PER_MINUTE = 450
SLUG_KEPT = r"a-z0-9\x{4e00}-\x{9fff}"
SLUG_GAP = f"[^{SLUG_KEPT}]+"
LEADING_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}-"
# Entities decoded without leaving the JVM; the ampersand comes last.
COMMON_ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&#x27;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", "\u00a0"),
    ("&copy;", "\u00a9"),
    ("&middot;", "\u00b7"),
    ("&mdash;", "\u2014"),
    ("&ndash;", "\u2013"),
    ("&hellip;", "\u2026"),
    ("&amp;", "&"),
)
TYPOGRAPHY = (("\u2013", "-"), ("\u2014", "-"), ("\u2212", "-"), ("\ufb01", "fi"), ("\ufb02", "fl"))
# ----------------------------------------------------------------------------------

#: ``SPACE`` for Java, whose classes try one range after the other: the first ones here turn down what is printed in ASCII.
_SPACE = rf"[\x{{0}}-\x{{20}}\x{{7f}}-\x{{ffff}}&&{SPACE}]"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where it is used several times
    inside a higher-order function, which shares no subexpressions by itself."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def replace_all(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Literal replacements in order: a later rule sees the output of an earlier one."""
    return reduce(lambda value, rule: F.replace(value, F.lit(rule[0]), F.lit(rule[1])), rules, text)


def rewrite_all(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Regular-expression replacements in order."""
    return reduce(lambda value, rule: F.regexp_replace(value, rule[0], rule[1]), rules, text)


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def squash(text: Column) -> Column:
    """Collapse white space to single blanks and trim.  A lone blank is already right, so
    only other runs are matched."""
    return F.trim(F.regexp_replace(text, f"{_SPACE}(?:(?<! )|(?={_SPACE})){SPACE}*", " "))


def strip(text: Column) -> Column:
    """Trim white space of any kind from both ends."""
    return F.trim(text, F.lit(SPACE_CHARS))


def decode_entities(text: Column) -> Column:
    """Decode the common entities with built-in expressions."""
    return replace_all(text, COMMON_ENTITIES)


@F.pandas_udf(T.StringType())
def decode_all_entities(text: pd.Series) -> pd.Series:
    """Decode every HTML entity (Arrow batches); use where rare entities matter."""
    return text.map(html.unescape, na_action="ignore")


def escape_html(text: Column, quote: bool = True) -> Column:
    rules = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")]
    if quote:
        rules += [('"', "&quot;"), ("'", "&#x27;")]
    return replace_all(text, rules)


def escape_xml(text: Column) -> Column:
    return replace_all(text, [("&", "&amp;"), (">", "&gt;"), ("<", "&lt;")])


def clean_text(text: Column, typography: bool = False, decode=decode_entities) -> Column:
    """Decoded, white space collapsed; ``typography`` also folds dashes and ligatures."""
    value = decode(F.coalesce(text, F.lit("")))
    return squash(replace_all(value, TYPOGRAPHY) if typography else value)


def lines(text: Column) -> Column:
    """Array of lines without their breaks; no empty line after a final break."""
    plain = F.regexp_replace(text, LINE_BREAK, "\n")
    return F.split(F.regexp_replace(plain, r"\n\z", ""), "\n")


def normalize_lines(text: Column) -> Column:
    """Each line without trailing white space, each closed by one line feed."""
    plain = F.regexp_replace(F.regexp_replace(text, LINE_BREAK, "\n"), r"\n\z", "")
    return F.concat(F.regexp_replace(plain, rf"{BLANK}+(\n|\z)", "$1"), F.lit("\n"))


def _hyphenate(text: Column, kept: str) -> Column:
    """Runs of anything but the ``kept`` characters become one hyphen, none at the ends.
    Blanks turn into hyphens first, so the pattern need not match each of them."""
    gap = f"-[^{kept}]+|[^\\-{kept}][^{kept}]*"
    return F.trim(F.regexp_replace(F.replace(text, F.lit(" "), F.lit("-")), gap, "-"), F.lit("-"))


def slugify(text: Column, default: str = "post", drop_date: bool = True) -> Column:
    value = strip(F.lower(text))
    if drop_date:
        value = F.regexp_replace(value, LEADING_DATE, "")
    return F.regexp_replace(_hyphenate(value, SLUG_KEPT), r"\A\z", default)


def slugify_words(text: Column, typography: bool = True) -> Column:
    """ASCII slug of a title."""
    value = F.lower(clean_text(text, typography))
    return F.regexp_replace(_hyphenate(value, "a-z0-9"), r"\A\z", "section")


def reading_units(text: Column) -> Column:
    return count_matches(F.regexp_replace(text, MARKDOWN_PUNCTUATION, ""), READING_UNIT)


def reading_minutes(text: Column) -> Column:
    """Minutes at the fixed rate, half-even rounding, at least one."""
    return F.greatest(F.lit(1), F.bround(reading_units(text) / F.lit(float(UNITS_PER_MINUTE)))).cast("long")


def count_chars(text: Column, char_class: str) -> Column:
    """Characters of a class: what the text loses when whole runs of them are removed, which
    is cheaper than matching them one by one."""
    return (F.length(text) - F.length(F.regexp_replace(text, f"{char_class}+", ""))).cast("long")


def latin_count(text: Column) -> Column:
    return count_chars(text, LATIN)


def cjk_count(text: Column) -> Column:
    return count_chars(text, CJK)


def without_urls(text: Column) -> Column:
    return F.regexp_replace(text, rf"https?://[^\n{BLANK_CHARS}]+", " ")


def date_label(raw: Column) -> Column:
    """``YYYY.MM.DD`` for an ISO date, anything else unchanged."""
    iso = F.when(raw.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), F.try_to_date(raw, "yyyy-MM-dd"))
    return F.coalesce(F.date_format(iso, "yyyy.MM.dd"), raw)


def feed_date(raw: Column, fallback: Column | None = None) -> Column:
    """RFC 822 date at midnight +0800; a date that does not parse becomes ``fallback`` (today)."""
    iso = F.when(raw.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.try_to_date(F.substring(raw, 1, 10), "yyyy-MM-dd"))
    day = F.coalesce(iso, fallback if fallback is not None else F.current_date())
    return F.concat(F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" 00:00:00 +0800"))


def version_label(raw: Column) -> Column:
    value = strip(F.coalesce(raw, F.lit("")))
    return F.when(value == "", F.lit("")).when(F.lower(value).startswith("v"), value).otherwise(F.concat(F.lit("v"), value))


def sha1_text(text: Column) -> Column:
    return F.sha1(F.encode(text, "UTF-8"))


def short_digest(content: Column, length: int = 12) -> Column:
    """First characters of the SHA-256 of the bytes; ``missing`` where there is none."""
    return F.coalesce(F.substring(F.sha2(content, 256), 1, length), F.lit("missing"))


def asset_url(path: Column, content: Column) -> Column:
    return F.concat(path, F.lit("?v="), short_digest(content))


def localized_name(url: Column) -> Column:
    """File name for a copied image: safe stem, digest of the full address, suffix."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*\z", ""), r"\A[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    leaf = F.regexp_extract(path, r"([^/]*)/*\z", 1)
    suffix = F.regexp_extract(leaf, r"[^.](\.[^.]+)\z", 1)
    stem = F.substring(leaf, F.lit(1), F.length(leaf) - F.length(suffix))
    safe = F.regexp_replace(F.regexp_replace(stem, "[^a-zA-Z0-9_-]+", "-"), r"\A-+|-+\z", "")
    return F.concat(
        F.coalesce(F.nullif(safe, F.lit("")), F.lit("image")),
        F.lit("-"),
        F.substring(sha1_text(url), 1, 12),
        F.coalesce(F.nullif(suffix, F.lit("")), F.lit(".png")),
    )


def polish(text: Column, glossary: Iterable[tuple[str, str]] = ()) -> Column:
    """Ordered glossary replacements, then no blanks around full-width punctuation."""
    return rewrite_all(
        replace_all(text, glossary),
        [
            (rf"{SPACE}+([，。！？；：、）》])", "$1"),
            (rf"([（《]){SPACE}+", "$1"),
        ],
    )


def strip_latex(text: Column) -> Column:
    """Displayed and inline formulas removed, white space collapsed."""
    return squash(
        rewrite_all(
            text,
            [
                (r"(?s)\\\[.*?\\\]", " "),
                (r"(?s)\\begin\{equation\*?\}.*?\\end\{equation\*?\}", " "),
                (r"(?s)\\begin\{split\}.*?\\end\{split\}", " "),
                (r"(?s)\\\(.*?\\\)", " "),
            ],
        )
    )


def matches_any(text: Column, patterns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.rlike(p) for p in patterns])


def contains_any(text: Column, needles: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(n) for n in needles])


def contains_all(text: Column, needles: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [text.contains(n) for n in needles])
