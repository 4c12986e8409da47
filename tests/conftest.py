from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from curatrix.session import build_session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "curatrix-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from curatrix.registry import Tables

    return Tables(spark, SMOKE)


@pytest.fixture
def frame(spark):
    """Build a small frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def value(spark):
    """Evaluate a column function on one Python value."""
    from pyspark.sql import functions as F

    def run(fn, argument, kind="string"):
        df = spark.createDataFrame([(argument,)], f"c {kind}")
        return df.select(fn(F.col("c")).alias("out")).first()["out"]

    return run
