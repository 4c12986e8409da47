"""Row filters that need more than one built-in call."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.dates import elapsed_days


def without_key(df: DataFrame, column: str, value) -> DataFrame:
    """Drop one key's rows; an absent key changes nothing and null keys stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def marker_to_null(df: DataFrame, marker: str = "[]") -> DataFrame:
    """Whole text values equal to `marker` become null, in all columns."""
    return df.replace(marker, None)


def flag_and_fill(df: DataFrame, column: str, flag: str, fill: str = "") -> DataFrame:
    """A 0/1 flag for a missing value, taken before the value is filled."""
    return df.withColumn(flag, F.col(column).isNull().cast("int")).withColumn(
        column, F.coalesce(F.col(column), F.lit(fill))
    )


def aged(df: DataFrame, created: str, now: Column, min_days: int, name: str) -> DataFrame:
    """Rows created at least `min_days` whole days ago, with that number of days.

    The cut is a plain comparison of the stored column, so it reaches the scan.
    """
    kind = dict(df.dtypes)[created]
    cutoff = (now - F.make_dt_interval(F.lit(min_days))).cast(kind)
    return df.filter(F.col(created) <= cutoff).withColumn(name, elapsed_days(F.col(created), now))


def search_articles(
    articles: DataFrame,
    start: date | datetime | str,
    end: date | datetime | str,
    topics: Sequence[str],
    concepts: Sequence[str],
    lang: str = "eng",
    data_types: Sequence[str] = ("news", "pr"),
    uris: Column | None = None,
) -> DataFrame:
    """Articles in a closed date range that carry a topic and a company concept.

    `uris` is the array of concept uris, by default that of the `concepts` structs.
    """
    uris = F.col("concepts.uri") if uris is None else uris
    return articles.filter(
        F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        & (F.col("lang") == lang)
        & F.col("data_type").isin(*data_types)
        & F.arrays_overlap(uris, F.array(*map(F.lit, topics)))
        & F.arrays_overlap(uris, F.array(*map(F.lit, concepts)))
    )
