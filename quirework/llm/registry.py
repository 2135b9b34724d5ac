"""Queries of this subpackage and the SQL each is checked against."""

from quirework.llm import chat, decontaminate, exact, extraction, mixing, neighbours, phrases, quality, repair, sharding, simhash, substrings, toxicity  # noqa: F401
from quirework.llm.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
