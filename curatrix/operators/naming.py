"""Naming-convention audit of an inventory."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.text import starts_with_any
from curatrix.session import settle

# Conventions and exceptions of the audit.
DATASET_PREFIXES = ("raw_", "curated_", "product_", "temporary")
TABLE_PREFIXES = ("insurance_", "banking_", "payments_", "omni_")
DATASET_WHITELIST = (
    "curated_taxonomies",
    "curated_business_metrics",
    "curated_hubspot",
    "raw_csv_imports",
    "raw_hubspot",
    "raw_business_metrics",
)
DATASET_WHITELIST_PREFIXES = ("product_index",)


_CLEAN = [("dataset", "none"), ("table", "All passing")]  # lines of a level without failures


@dataclass(frozen=True)
class Conventions:
    """Allowed prefixes, and names the audit skips; empty tuples skip nothing."""

    dataset_prefixes: Sequence[str] = DATASET_PREFIXES
    table_prefixes: Sequence[str] = TABLE_PREFIXES
    skip_datasets: Sequence[str] = DATASET_WHITELIST
    skip_dataset_prefixes: Sequence[str] = DATASET_WHITELIST_PREFIXES
    skip_tables: Sequence[str] = ()
    skip_table_prefixes: Sequence[str] = ()


def _skipped(c: Column, names: Sequence[str], prefixes: Sequence[str]) -> Column:
    exact = c.isin(*names) if names else F.lit(False)
    return exact | starts_with_any(c, prefixes)


def naming_failures(inventory: DataFrame, rules: Conventions = Conventions(), by: Sequence[str] = ()) -> DataFrame:
    """`(level, item)` for each dataset and table that breaks a convention.

    A skipped dataset takes all its tables with it. Columns `by`, such as the project, are
    kept before them.
    """
    dataset, table = F.col("dataset_id"), F.col("table_id")
    checked = inventory.filter(
        ~_skipped(dataset, rules.skip_datasets, rules.skip_dataset_prefixes)
    )
    datasets = (
        checked.filter(~starts_with_any(dataset, rules.dataset_prefixes))
        .select(*by, F.lit("dataset").alias("level"), dataset.alias("item"))
        .distinct()
    )
    tables = checked.filter(
        table.isNotNull()
        & ~_skipped(table, rules.skip_tables, rules.skip_table_prefixes)
        & ~starts_with_any(table, rules.table_prefixes)
    ).select(*by, F.lit("table").alias("level"), F.concat_ws(".", dataset, table).alias("item"))
    return datasets.unionByName(tables)


def naming_report(inventory: DataFrame, rules: Conventions = Conventions(), by: Sequence[str] = ()) -> DataFrame:
    """Sorted report lines; a level without failures says so in one line.

    With `by` each of its values, as each project, has a report of its own, also one
    without a failure. The report stays one row per line, so its length is not bound by a
    task.
    """
    inventory = settle(inventory, "inventory")
    failures = naming_failures(inventory, rules, by)
    empty = inventory.sparkSession.createDataFrame(_CLEAN, "level string, item string")
    if by:
        empty = inventory.select(*by).distinct().select(
            *by, F.inline(F.array(*(F.struct(F.lit(n).alias("level"), F.lit(i).alias("item")) for n, i in _CLEAN)))
        )
    failing = failures.select(*(F.col(c).alias(f"_{c}") for c in (*by, "level"))).distinct()
    same = F.lit(True)
    for c in (*by, "level"):  # a null project is one as any other
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    clean = empty.join(failing, same, "left_anti")
    lines = failures.withColumn("line", F.concat(F.lit("\n"), "item")).unionByName(
        clean.withColumn("line", F.col("item"))
    )
    return lines.orderBy(*by, "level", "item")
