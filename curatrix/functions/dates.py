"""Date and time functions. `now` is always an argument, so a job can be repeated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def parse_day_first(c: Column) -> Column:
    """`d/M/yyyy` with a four-digit year as a date; null for anything else."""
    return F.when(
        F.regexp_like(c, F.lit(r"^\d{1,2}/\d{1,2}/\d{4}\z")), F.try_to_date(c, "d/M/yyyy")
    )


def slashed(c: Column) -> Column:
    return F.date_format(c, "yyyy/MM/dd")


def elapsed_days(since: Column, now: Column) -> Column:
    """Whole 24-hour periods, floored, so a future stamp is negative."""
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(since.cast("timestamp"))
    return ((micros - F.pmod(micros, F.lit(MICROS_PER_DAY))) / F.lit(MICROS_PER_DAY)).cast("long")


def clock_text(c: Column) -> Column:
    return F.date_format(c, "hh:mm a")


def iso_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def run_suffix(c: Column) -> Column:
    """Suffix for output folders, such as `feb01_1504`."""
    return F.lower(F.date_format(c, "MMMdd_HHmm"))
