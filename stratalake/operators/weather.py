"""Checks on weather documents, and documents to hourly rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.constants import WEATHER_ARRAYS


def document_is_valid() -> Column:
    """The `hourly` part is there, holds the three arrays, and they are equally long."""
    time, *others = [F.array_size(f"hourly.{name}") for name in WEATHER_ARRAYS]
    valid = F.col("hourly").isNotNull()
    for other in others:
        valid = valid & (time == other)
    return F.coalesce(valid, F.lit(False))


def check_documents(documents: DataFrame, document_id: str) -> DataFrame:
    """One report row per document: array lengths (NULL if absent) and a verdict."""
    return documents.select(
        document_id,
        F.col("hourly").isNotNull().alias("has_hourly"),
        *[F.array_size(f"hourly.{name}").alias(f"n_{name}") for name in WEATHER_ARRAYS],
        document_is_valid().alias("is_valid"),
    )


def require_valid_documents(documents: DataFrame) -> DataFrame:
    """The same documents; a malformed one fails the job that reads it."""
    guard = F.when(document_is_valid(), F.col("hourly")).otherwise(
        F.raise_error(F.lit("weather document without three equally long hourly arrays"))
    )
    return documents.withColumn("hourly", guard)


def hourly_rows(documents: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per hour; `_at` is the position inside the document."""
    zipped = F.arrays_zip(*[F.col(f"hourly.{name}").alias(name) for name in WEATHER_ARRAYS])
    return documents.select(
        "latitude", "longitude", *carry, F.posexplode(zipped).alias("_at", "hour"),
    ).select(
        F.col("hour.time").cast("timestamp_ntz").alias("ts_utc"),
        F.col("hour.temperature_2m").alias("temp_c"),
        F.col("hour.relative_humidity_2m").alias("rh_pct"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        *carry,
        "_at",
    )
