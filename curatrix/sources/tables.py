"""Table, SQL and in-memory sources."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from curatrix.schemas import conform


def scan_table(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A catalog table, or a parquet folder when `name` holds a slash."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    return conform(df, schema) if schema is not None else df


def scan_sql(
    spark: SparkSession,
    query: str,
    frames: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, object] | None = None,
) -> DataFrame:
    """SQL over `{name}` frames with `:name` parameters.

    Values are bound as literals, never spliced into the text. The name of a table or
    column is a parameter inside `IDENTIFIER(:name)`: it can only name something, and text
    that is no name is refused.
    """
    return spark.sql(query, args=dict(args or {}), **dict(frames or {}))


def from_records(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """In-memory rows; the declared schema keeps the columns of an empty input."""
    return spark.createDataFrame(list(rows), schema)
