"""What the operators of this subpackage share: reading, stored intermediates, word bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Whole texts travel to Python, so a batch holds few rows.
SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}

#: The white space of the contracts: blank and U+0009 to U+000D.  ``bytes.split()`` splits at the same bytes.
BLANKS = " \t\n\x0b\x0c\r"


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL where SQL can express it."""

    def add(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            for key, value in SETTINGS.items():
                spark.conf.set(key, value)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLE[function.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    return materialize(df)


def hashed_share(df: DataFrame, size: int, *columns: str) -> DataFrame:
    """About ``size`` rows of a stored table, chosen by a hash of the columns; all of them where there are fewer."""
    share = size / max(1, df.count())
    if share >= 1:
        return df
    return df.filter(F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < int(share * (1 << 40)))


def text_bytes(column: str | Column = "text") -> Column:
    """UTF-8 bytes of a text; a null text is empty."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(value, F.lit("")).cast("binary")


def text_digest(column: str | Column = "text") -> Column:
    """SHA-256 of a text; with the doc_id it tells rows apart that repeat an id or have none."""
    return F.sha2(text_bytes(column), 256)


def arrow_rows(batches: Iterator[pa.RecordBatch], schema: pa.Schema, each) -> Iterator[pa.RecordBatch]:
    """``each(batch) -> list of column value lists``, one output batch per input batch."""
    for batch in batches:
        columns = each(batch)
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, schema.types)], schema=schema)
