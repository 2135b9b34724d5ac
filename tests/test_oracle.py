"""Every query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points

FOLDER = os.environ.get("QUIREWORK_TEST_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def rows(frame):
    columns = sorted(frame.columns)

    def plain(v):
        if v is None or v != v:
            return None
        return round(float(v), 9) if isinstance(v, float) else v

    data = frame[columns].astype(object).where(frame[columns].notna(), None)
    return columns, sorted((tuple(plain(v) for v in row) for row in data.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, FOLDER)
    if name not in ORACLE:
        assert found.count() > 0
        return
    assert rows(found.toPandas()) == rows(duck.execute(ORACLE[name]).df())


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
