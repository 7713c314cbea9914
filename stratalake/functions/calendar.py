"""Date parts of the calendar and weather dimensions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """2025-08-01 -> 20250801."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def iso_weekday(day: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(day) + 1


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "E")


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMM")


def is_weekend(day: Column) -> Column:
    return F.coalesce(iso_weekday(day).isin(6, 7), F.lit(False))


def utc_stamp(moment: Column) -> Column:
    """2025-08-01 03:00:00 -> 20250801T030000Z, for a UTC session or a zone-free column."""
    return F.date_format(moment, "yyyyMMdd'T'HHmmss'Z'")
