"""Inventory of datasets and their tables."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.schemas import INVENTORY, conform


def inventory(df: DataFrame) -> DataFrame:
    """A stored inventory, checked against the declared columns."""
    return conform(df, INVENTORY)


def _described(spark: SparkSession, name: str) -> dict:
    return json.loads(spark.sql("DESCRIBE EXTENDED IDENTIFIER(:name) AS JSON", args={"name": name}).first()[0])


def _moment(text: str | None) -> datetime | None:
    try:
        return datetime.strptime(text or "", "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc)
    except ValueError:  # the catalog writes a word where it does not know
        return None


def _changed(spark: SparkSession, name: str) -> datetime | None:
    """When the newest file of a table was written; only file statuses are read."""
    try:
        newest = spark.table(name).agg(F.unix_micros(F.max("_metadata.file_modification_time")))
        micros = newest.first()[0]
    except AnalysisException:  # not stored in files
        return None
    return None if micros is None else datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=micros)


def inventory_from_catalog(spark: SparkSession, project: str, at_once: int = 8) -> DataFrame:
    """One row per table of the session catalog, with the times of creation and change.

    A table changed when its newest file was written, a view or an empty table when it was
    created; a time the catalog does not know is null. A dataset without tables gives one
    row with a null table. Tables are described side by side; the driver holds their
    names and times.
    """
    listed: list[tuple[str, str | None]] = []
    for database in spark.catalog.listDatabases():
        names = [t.name for t in spark.catalog.listTables(database.name) if not t.isTemporary]
        listed += [(database.name, name) for name in names] or [(database.name, None)]

    def row(entry: tuple[str, str | None]) -> tuple:
        database, name = entry
        if name is None:
            return project, database, None, None, None, None
        quoted = ".".join(f"`{part.replace('`', '``')}`" for part in entry)
        about = _described(spark, quoted)
        created = _moment(about.get("created_time"))
        if about.get("type") == "VIEW":
            return project, database, name, "VIEW", created, created
        return project, database, name, "TABLE", created, _changed(spark, quoted) or created

    with ThreadPoolExecutor(at_once) as pool:
        rows = list(pool.map(row, listed))
    return spark.createDataFrame(rows, INVENTORY)
