"""Stored web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fetched_pages(pages: DataFrame) -> DataFrame:
    """Pages that answered with status 200; without a status column all of them."""
    if "status" not in pages.columns:
        return pages
    return pages.filter(F.col("status") == 200)
