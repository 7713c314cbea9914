"""Rows that carry the largest key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, key: str) -> DataFrame:
    """All rows whose key equals the overall maximum.

    The maximum is a scalar subquery over that one column. Its value then reaches the scan as
    a pushed filter, or prunes partitions if the key is a partition column.
    """
    return df.where(F.col(key) == df.select(F.max(key)).scalar())


def newest_day(df: DataFrame, time: str) -> DataFrame:
    """All rows of the last day that occurs in a timestamp column."""
    midnight = F.to_date(F.max(time)).cast("timestamp_ntz")
    return df.where(F.col(time) >= df.select(midnight).scalar())
