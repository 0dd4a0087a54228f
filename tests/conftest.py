"""One local session for all tests; its shared folder is new for every run."""

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "4g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-")},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """``table("id BIGINT, name STRING", (1, "a"), …)``"""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture
def values():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect


@pytest.fixture
def apply(spark):
    """Values of a column function over a list of single inputs, in order."""

    def run(function, inputs, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i INT, v {kind}")
        from pyspark.sql import functions as F

        out = rows.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()
        return [tuple(r.o) if hasattr(r.o, "asDict") else r.o for r in out]

    return run
