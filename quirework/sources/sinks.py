"""Writers.  Files are written by the tasks that hold the rows; nothing passes the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import html as hx
from quirework.functions import text as tx


def write_documents(docs: DataFrame, folder: str, slug: str, content: str, normalize: bool = True, html: bool = False) -> None:
    """One text file per row under ``folder/<slug>=…/``, replacing what was there."""
    body = F.col(content)
    if html:
        body = hx.repair_doctype(body)
    elif normalize:
        body = tx.normalize_lines(body)
    # The writer closes each row with a line feed of its own.
    rows = docs.select(slug, F.regexp_replace(body, r"\n\z", "").alias("value"))
    rows.repartition(slug).write.mode("overwrite").partitionBy(slug).text(folder)


def write_ordered_text(rows: DataFrame, folder: str, unit: Sequence[str], order: Sequence[str], value: str) -> None:
    """Ordered text per unit: range-partitioned by (unit, order), so a large unit becomes
    several consecutive files and is never gathered."""
    chosen = rows.select(*unit, *order, F.col(value).alias("value"))
    sorted_rows = chosen.repartitionByRange(*unit, *order).sortWithinPartitions(*unit, *order)
    sorted_rows.select(*unit, "value").write.mode("overwrite").partitionBy(*unit).text(folder)


def write_json(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").json(folder)


def write_keyed(rows: DataFrame, folder: str) -> None:
    """Append keyed results; later readers keep the latest per key."""
    rows.write.mode("append").parquet(folder)


def site_map_lines(urls: DataFrame, site: str) -> DataFrame:
    """Entry lines of a site map in (section, sort_key) order."""
    entry: Column = F.concat(F.lit("  <url><loc>"), F.lit(site), F.col("url"), F.lit("</loc></url>"))
    return urls.select("section", "sort_key", entry.alias("value"))


def write_site_map(urls: DataFrame, site: str, folder: str) -> None:
    """Site map in sorted part files of entries; ``append_entries`` adds to a finished one."""
    lines = site_map_lines(urls, site)
    lines.repartitionByRange("section", "sort_key").sortWithinPartitions("section", "sort_key").select("value").write.mode(
        "overwrite"
    ).text(folder)


def append_entries(raw: Column, entries: Column) -> Column:
    """A finished site map with more entries before its end; nothing is deduplicated."""
    return F.replace(raw, F.lit("</urlset>"), F.concat(entries, F.lit("\n</urlset>")))
