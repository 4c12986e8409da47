"""Reports over a table inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.dates import clock_text, elapsed_days
from curatrix.operators.filters import aged
from curatrix.operators.naming import Conventions, naming_report
from curatrix.sinks.export import export_tables
from curatrix.sources.inventory import inventory as checked_inventory


def naming_audit(
    inventory: DataFrame, rules: Conventions = Conventions(), now: Column | None = None, by_project: bool = False
) -> DataFrame:
    """The naming report, with the clock time of `now` on every line when it is given.

    `by_project` gives each project of the inventory its own report and names it on every line.
    """
    report = naming_report(checked_inventory(inventory), rules, ("project",) if by_project else ())
    return report if now is None else report.withColumn("time", clock_text(now))


def table_ages(inventory: DataFrame, now: Column, dataset: str | None = None, min_days: int = 30) -> DataFrame:
    """Tables created at least `min_days` days ago with days since creation and change."""
    tables = checked_inventory(inventory).filter(F.col("table_id").isNotNull())
    if dataset is not None:
        tables = tables.filter(F.col("dataset_id") == dataset)
    old = aged(tables, "created", now, min_days, "days_since_created").withColumn(
        "days_since_modified", elapsed_days(F.col("modified"), now)
    )
    message = F.format_string(
        "%s was created %d days ago and last modified %d days ago.",
        "table_id",
        "days_since_created",
        "days_since_modified",
    )
    return old.select(
        "dataset_id", "table_id", "days_since_created", "days_since_modified", message.alias("message")
    )


def export(inventory: DataFrame, load, root: str, fmt: str = "parquet", max_bytes: int | None = None) -> DataFrame:
    return export_tables(checked_inventory(inventory), load, root, fmt, max_bytes=max_bytes)
