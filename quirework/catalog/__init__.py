"""Named queries over the given tables, each with the SQL it is checked against."""

from quirework.catalog import batches, book, corpus, document, elements, indicators, layout, pages, texts, units  # noqa: F401  (they register)
from quirework.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
