"""Counts per company against a published index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.operators.joins import count_matches, difference, left_join
from curatrix.operators.ranking import index_ranks
from curatrix.schemas import COMPANY_IDS, PATENTS, conform
from curatrix.sources.files import scan_csv_columns

# Headers of the published file; two of them hold a line break.
INDEX_COLUMNS = (
    ("Company", "Company", "string"),
    ("Indicator Code", "Indicator Code", "string"),
    ("Raw Value\n2023", "2023 Index Patent Count", "bigint"),
    ("Raw Value\n2024", "2024 Index Patent Count", "bigint"),
)


def published_index(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv_columns(spark, path, INDEX_COLUMNS)


def count_change(
    company_ids: DataFrame, patents: DataFrame, index: DataFrame, sector: str = "bank"
) -> DataFrame:
    """New count per company of a sector, the published count, and the change.

    Names are compared as they are. A company that was not published has no change.
    """
    ids = conform(company_ids, COMPANY_IDS).filter(F.col("sector") == sector)
    new = count_matches(
        ids, conform(patents, PATENTS), "id", "company_id", "url", "company", "New Patent Count"
    ).withColumnRenamed("company", "Company")
    published = index.select("Company", "2024 Index Patent Count")
    joined = left_join(new, published, "Company")
    return difference(joined, "New Patent Count", "2024 Index Patent Count", "Change")


def published_ranks(index: DataFrame) -> DataFrame:
    """Ranks, changes and leader per indicator of the published file."""
    return index_ranks(
        index, "Indicator Code", "Company", "2023 Index Patent Count", "2024 Index Patent Count"
    )
