"""Company calendar events: raw rows from stored pages, and the curated table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.functions.dates import parse_day_first, slashed
from curatrix.functions.text import tidy_event_name
from curatrix.operators.joins import left_join
from curatrix.operators.pages import split_row, table_rows
from curatrix.operators.terms import keyword_tags, without_tags
from curatrix.schemas import CALENDAR_LINKS, EVENTS_RAW, conform
from curatrix.session import materialise

# Events that are left out of the curated table.
EXCLUDED_EVENTS = {"NOT_INTERESTING": ["dividend", "Détachement"]}


def dated_rows(pages: DataFrame, strict: bool = False) -> DataFrame:
    """`(url, date, event)` per row of each page's event table, `date` as written."""
    rows = table_rows(pages)
    return split_row(rows, F.col("row_text"), "url" if strict else None).select("url", "date", "event")


def events_and_rejects(
    pages: DataFrame, calendar_links: DataFrame, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Events with company and date, and the rows whose date cannot be read.

    Several companies may share a page, and each gets its rows. Pages are parsed and
    written once; both results come from that table.
    """
    companies = conform(calendar_links, CALENDAR_LINKS).distinct()
    # Repeats of a row collapse before the join, which only multiplies them.
    rows = materialise(dated_rows(pages, strict).distinct(), "event-rows")
    rows = rows.withColumn("_day", parse_day_first(F.col("date")))
    joined = left_join(
        rows.filter(F.col("_day").isNotNull()),
        companies,
        "url",
        "market_screener_link",
        hot_right=True,
    )
    events = joined.select(
        "name", slashed(F.col("_day")).alias("date"), "company_id", "event"
    ).dropDuplicates()
    return events, rows.filter(F.col("_day").isNull()).drop("_day")


def events_raw(pages: DataFrame, calendar_links: DataFrame, strict: bool = False) -> DataFrame:
    """The events of `events_and_rejects` alone."""
    return events_and_rejects(pages, calendar_links, strict)[0]


def bad_dates(pages: DataFrame) -> DataFrame:
    return dated_rows(pages).filter(parse_day_first(F.col("date")).isNull())


def events_curated(raw: DataFrame, excluded: dict[str, list[str]] = EXCLUDED_EVENTS) -> DataFrame:
    """Events with tidied names, without those an exclusion keyword matches."""
    named = conform(raw, EVENTS_RAW).withColumn("event", tidy_event_name(F.col("event")))
    tagged = named.withColumn("not_interesting", keyword_tags(F.col("event"), excluded))
    return without_tags(tagged, "not_interesting").select("date", "event", "name")
