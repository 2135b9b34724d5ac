import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quirework.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "quirework-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.quirework.spread": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate one expression over literal columns."""

    def run(expression, **columns):
        from pyspark.sql import functions as F

        frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()] or ["id"])
        return frame.select(expression.alias("x")).first()["x"]

    return run
