"""Titles of outline entries, captions and headings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.functions import html as hx
from quirework.functions import text as tx

# --- fixed values -----------------------------------------------------------------
NAMED_SECTIONS = {
    "contents": "contents",
    "table of contents": "contents",
    "preface": "preface",
    "preface to the first edition": "preface-first-edition",
    "notation": "notation",
    "acknowledgments": "acknowledgments",
    "acknowledgements": "acknowledgments",
    "about the authors": "about-the-authors",
    "introduction": "introduction",
    "references": "references",
    "bibliography": "bibliography",
    "index": "index",
}
WORDED_CHAPTER = r"(?i)\A(?:chapter|ch\.?)\s+([0-9]+)\b"
COLON_CHAPTER = r"(?i)\Achapter\s+([0-9]+)\s*:\s*.+\z"
NUMBERED_CHAPTER = r"\A([0-9]{1,2})\s+.+\z"
WORDED_APPENDIX = r"(?i)\Aappendix\s+([a-z0-9]+)\b"
LETTER_APPENDIX = r"\A([A-Z])\s+.+\z"
NUMBERED_SECTION = r"\A([0-9]+(?:\.[0-9]+)+)\s+.+\z"
CAPTION_NUMBER = r"([0-9]+(?:[.-][0-9A-Za-z]+)*)"
EXHIBIT_CAPTION = rf"(?i)\A(Exhibit|Figure|Fig\.|Table|Panel)\s+{CAPTION_NUMBER}(?:\s*[:.\-]\s*|\s+)(.+)\z"
FIGURE_CAPTION = rf"(?i)\A(Fig\.)\s+{CAPTION_NUMBER}(?:\.|\s+)(.*)\z"
TABLE_CAPTION = rf"(?i)\A(Table)\s+{CAPTION_NUMBER}(?:\.|\s+)(.*)\z"
DOTTED_CAPTION = r"(?i)\A(Figure|Fig\.|Exhibit|Table)\s+([0-9]+(?:\.[0-9]+)*)(?:\s*[:.\-]\s*|\s+)(.+)\z"
NUMBERED_TITLE = r"\A([A-Z]?[0-9]*(?:\.[0-9]+)+|[A-Z]\.[0-9]+)\s+(.+)\z"
SECTION_NUMBER = r"\A([A-Z]?[0-9]+(?:\.[0-9]+)+|[A-Z]\.[0-9]+)\b"
# ----------------------------------------------------------------------------------

_NUMBERED_SLUGS = ("contents", "table of contents", "preface", "preface to the first edition", "notation", "references", "index")
_WORDED_SLUGS = tuple(k for k in NAMED_SECTIONS if k not in ("notation", "preface to the first edition"))


def _named(lower: Column, names) -> Column:
    pick = F.lit(None).cast("string")
    for name in names:
        pick = F.when(lower == name, F.lit(NAMED_SECTIONS[name])).otherwise(pick)
    return pick


def _chapter(title: Column, pattern: str) -> Column:
    number = F.regexp_extract(title, pattern, 1)
    return F.when(title.rlike(pattern), F.concat(F.lit("chapter-"), number.cast("bigint").cast("string")))


def title_slug(title: Column, style: str = "worded") -> Column:
    """Slug of an outline title: named section, chapter, appendix, numbered section, words.

    ``worded`` knows "Chapter 3" and "Appendix B"; ``numbered`` knows "3 Title", "B Title"
    and "3.1 Title"; ``colon`` knows "Chapter 3: Title" only.
    """
    clean = tx.clean_text(title, typography=style == "numbered")
    lower = F.lower(clean)
    words = tx.slugify_words(clean, typography=style == "numbered")
    if style == "worded":
        letter = F.when(
            clean.rlike(WORDED_APPENDIX), F.concat(F.lit("appendix-"), F.lower(F.regexp_extract(clean, WORDED_APPENDIX, 1)))
        )
        return F.coalesce(_named(lower, _WORDED_SLUGS), _chapter(clean, WORDED_CHAPTER), letter, words)
    if style == "numbered":
        letter = F.regexp_extract(clean, LETTER_APPENDIX, 1)
        appendix = F.when((letter != "") & (letter != "I"), F.concat(F.lit("appendix-"), F.lower(letter)))
        number = F.regexp_extract(clean, NUMBERED_SECTION, 1)
        section = F.when(number != "", F.concat(F.lit("section-"), F.replace(number, F.lit("."), F.lit("-"))))
        return F.coalesce(_named(lower, _NUMBERED_SLUGS), _chapter(clean, NUMBERED_CHAPTER), appendix, section, words)
    if style == "colon":
        kept = F.when(lower.isin("introduction", "contents", "index", "bibliography", "references"), lower)
        return F.coalesce(_chapter(lower, COLON_CHAPTER), kept, words)
    raise ValueError(f"unknown style {style!r}")


def unit_kind(title: Column, style: str = "worded") -> Column:
    """Kind of an outline entry; the order of the tests differs per style."""
    clean = tx.clean_text(title, typography=style == "numbered")
    lower = F.lower(clean)
    contents = lower.isin("contents", "table of contents")
    if style == "worded":
        front = lower.isin("preface", "acknowledgments", "acknowledgements", "about the authors", "introduction")
        back = lower.isin("references", "bibliography", "index") | lower.rlike(WORDED_APPENDIX)
        return (
            F.when(contents, F.lit("contents"))
            .when(back, F.lit("back_matter"))
            .when(lower.rlike(WORDED_CHAPTER), F.lit("chapter"))
            .when(front, F.lit("front_matter"))
            .otherwise(F.lit("section"))
        )
    if style == "numbered":
        return (
            F.when(contents, F.lit("contents"))
            .when((lower == "index") | clean.rlike(LETTER_APPENDIX), F.lit("back_matter"))
            .when(lower.startswith("preface") | (lower == "notation"), F.lit("front_matter"))
            .when(clean.rlike(NUMBERED_CHAPTER), F.lit("chapter"))
            .otherwise(F.lit("section"))
        )
    if style == "colon":
        return (
            F.when(lower == "introduction", F.lit("introduction"))
            .when(lower.rlike(COLON_CHAPTER), F.lit("chapter"))
            .when(lower.isin("index", "bibliography", "references"), F.lit("back_matter"))
            .when(lower == "contents", F.lit("contents"))
            .otherwise(F.lit("front_or_back_matter"))
        )
    raise ValueError(f"unknown style {style!r}")


_PAGE_NUMBER = r"\s+[0-9]{1,4}\z"


def strip_page_number(text: Column) -> Column:
    return tx.strip(F.regexp_replace(text, _PAGE_NUMBER, ""))


#: Words of printed ASCII between single blanks, without tags and entities: node text as it is.
_PLAIN = r"\A[!-%'-;=-~]++(?: [!-%'-;=-~]++)*+\z"


def canonical_heading(text: Column) -> Column:
    """Comparison form of a heading: no tags, page number, case, punctuation or blanks."""
    shown = F.when(text.rlike(_PLAIN), text).otherwise(hx.node_text(text))
    value = F.lower(F.regexp_replace(F.regexp_replace(shown, _PAGE_NUMBER, ""), "(?i)copulas", "copula"))
    return F.regexp_replace(value, r"[^\p{L}\p{N}_]+", "")


def comparison_title(text: Column) -> Column:
    """Looser comparison form used to find a repeated title."""
    bare = tx.decode_entities(F.regexp_replace(text, hx.ANY_TAG, ""))
    return F.lower(F.regexp_replace(bare, rf"[\n{tx.BLANK_CHARS}:：,，.。;；!！?？\-—_《》「」“”\"'()（）]+", ""))


def section_number(title: Column, slug: Column) -> Column:
    """Printed number of a section: from its title, else rebuilt from its slug."""
    from_title = F.nullif(F.regexp_extract(title, SECTION_NUMBER, 1), F.lit(""))
    digits = r"\Asection-([0-9]+)-([0-9]+)"
    letter = r"(?i)\Asection-([a-z])-([0-9]+)"
    numeric = F.when(slug.rlike(digits), F.concat_ws(".", F.regexp_extract(slug, digits, 1), F.regexp_extract(slug, digits, 2)))
    lettered = F.when(
        slug.rlike(letter), F.concat_ws(".", F.upper(F.regexp_extract(slug, letter, 1)), F.regexp_extract(slug, letter, 2))
    )
    return F.coalesce(from_title, numeric, lettered, F.lit(""))


def has_expected_number(shown: Column, title: Column, slug: Column) -> Column:
    number = section_number(title, slug)
    return (number == "") | strip_page_number(hx.node_text(shown)).startswith(number)


def number_heads_label(label: Column, number: Column) -> Column:
    """The label starts with the number, followed by a break, punctuation or nothing."""
    rest = F.substr(F.ltrim(label), F.length(number) + 1)
    return F.ltrim(label).startswith(number) & ((rest == "") | rest.rlike(r"\A[\s.:：、．]"))


def drop_repeated_heading(fragment: Column, title: Column, rounds: int = 3) -> Column:
    """Remove a leading h1/h2 that repeats the title, inside or outside the section tag."""
    target = comparison_title(title)
    lead = r"(?is)\A(\s*(?:<section\b[^>]*>\s*)?)(?:<h1\b[^>]*>.*?</h1>|<h2\b[^>]*>.*?</h2>)\s*"
    inner = r"(?is)\A\s*(?:<section\b[^>]*>\s*)?<h[12]\b[^>]*>(.*?)</h[12]>"
    value = fragment
    for _ in range(rounds):
        found = comparison_title(F.regexp_extract(value, inner, 1))
        same = (target != "") & (found != "") & (F.contains(found, target) | F.contains(target, found))
        value = F.when(same, F.regexp_replace(value, lead, "$1")).otherwise(value)
    return value


def has_initial_heading(fragment: Column) -> Column:
    return fragment.rlike(
        r"(?is)\A\s*(?:<section\b[^>]*>\s*(?:<div\b[^>]*>\s*)?)?(?:<h1\b[^>]*>.*?</h1>|<h2\b[^>]*>.*?</h2>)"
    )


def drop_running_headers(text: Column) -> Column:
    """Page headers ("12 CHAPTER 3 TITLE") in front of translated text or markup."""
    return F.regexp_replace(
        text, r"\b[0-9]{1,4}\s+CHAPTER\s+[0-9]+\s+[A-Z][A-Za-z,:\-\s]+(?=[\x{4e00}-\x{9fff}<])", ""
    )


def is_notice_page(text: Column, markers, limit: int = 900, empty: bool = False) -> Column:
    """A page with nothing but the publisher's notice; ``empty`` says what a blank page is."""
    return tx.bind(
        tx.clean_text(text),
        lambda clean: F.when(clean == "", F.lit(empty)).otherwise(
            (F.length(clean) <= limit) & tx.contains_all(F.lower(clean), markers)
        ),
    )
