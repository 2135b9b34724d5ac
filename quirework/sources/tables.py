"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str, spread: str | None = None) -> DataFrame:
    """A table with only the columns asked for, so the scan reads no others.

    ``spread`` names a key for inputs with much work per row.  Where the session sets
    ``spark.quirework.spread`` to a number of partitions, the rows are hashed on the key
    into so many; that serves single small files with few row groups.  Unset, as for large tables,
    the scan keeps its own splits and nothing is shuffled.
    """
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    df = df.select(*columns) if columns else df
    parts = spark.conf.get("spark.quirework.spread", None)
    return df.repartition(int(parts), spread) if spread and parts else df
