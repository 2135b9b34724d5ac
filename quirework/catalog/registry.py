"""Registration of queries, and SQL fragments for the checking side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quirework.functions import html as hx
from quirework.functions import text as tx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL where SQL can express it."""

    def add(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return add


def q(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def sub(value: str, pattern: str, to: str = " ") -> str:
    return f"regexp_replace({value}, {q(pattern)}, {q(to)}, 'g')"


def squash(value: str) -> str:
    return f"trim({sub(value, tx.SPACE + '+')}, ' ')"


def strip(value: str) -> str:
    return sub(value, rf"\A{tx.SPACE}+|{tx.SPACE}+\z", "")


def replaces(value: str, rules) -> str:
    for old, new in rules:
        value = f"replace({value}, {q(old)}, {q(new)})"
    return value


def decode(value: str) -> str:
    return replaces(value, tx.COMMON_ENTITIES)


def markup(value: str) -> str:
    return sub(sub(value, hx.SCRIPT_ELEMENT), hx.COMMENT)


def visible(value: str) -> str:
    return squash(sub(sub(sub(value, hx.HIDDEN_ELEMENT), hx.COMMENT), hx.ANY_TAG))


def node_text(value: str) -> str:
    return squash(decode(sub(value, hx.ANY_TAG)))


def found(value: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({value}, {q(pattern)}, {group})"


def count(value: str, pattern: str) -> str:
    return f"len({found(value, pattern)})"


def text_lines(value: str) -> str:
    """List of lines; a final line break opens no further line."""
    plain = f"regexp_replace({value}, {q(tx.LINE_BREAK)}, chr(10), 'g')"
    return f"string_split(regexp_replace({plain}, '\\n\\z', ''), chr(10))"


def hrefs(value: str) -> str:
    raw = found(markup(value), hx.attribute_pattern("a", "href"), 1)
    bare = sub("v", r"\A[\"']|[\"']\z", "")
    return f"list_filter(list_transform({raw}, lambda v: {decode(bare)}), lambda v: v <> '')"


def slug(value: str, default: str = "post") -> str:
    inner = sub(sub(f"lower({strip(value)})", tx.LEADING_DATE, ""), tx.SLUG_GAP, "-")
    return f"coalesce(nullif(trim({inner}, '-'), ''), {q(default)})"
