"""Daily weather from partial results per day, so that a run reads only the hours of the days it touched.

A partial result holds counts, sums, minima and maxima of one day: in double for the gold file, in exact decimals for
the dimension. The gold file and both dimensions are read from these rows alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import calendar
from stratalake.functions.numeric import nan_to_null
from stratalake.plans import dims, staging
from stratalake.sinks.files import DAY, on_days, read_hourly

MONTH = "month"


def day_parts(hourly: DataFrame) -> DataFrame:
    """One row per day: number of hours, and partial results of temperature and humidity."""
    given = nan_to_null(F.col("given"))
    staged = hourly.selectExpr(*staging.weather_columns(hourly), "CAST(temp_c AS DOUBLE) AS given")
    return staged.groupBy(F.to_date("ts_utc").alias("date")).agg(
        F.count(F.lit(1)).alias("n_hours"),
        F.count(given).alias("n_given"), F.sum(given).alias("given_sum"), F.min(given).alias("given_min"), F.max(given).alias("given_max"),
        F.count("temp_c").alias("n_temp"), F.sum(F.col("temp_c").cast("decimal(20,2)")).cast("decimal(20,2)").alias("temp_sum"),
        F.min("temp_c").alias("temp_min"), F.max("temp_c").alias("temp_max"),
        F.count("rh_pct").alias("n_rh"), F.sum(F.col("rh_pct").cast("decimal(20,2)")).cast("decimal(20,2)").alias("rh_sum"),
    )


def update_parts(spark: SparkSession, silver_path: str, path: str, days: Sequence[date | None] | None) -> DataFrame:
    """Replaces the rows of the given days, or of all if there are none stored or `days` is None; returns all rows.

    The rows are stored by month. Of a touched month the rows of other days are carried over; other
    months keep their files.
    """
    hourly, stored = read_hourly(spark, silver_path), read_hourly(spark, path)
    if stored is None or days is None:
        fresh, mode = day_parts(hourly), "static"
    else:
        months = sorted({_month(d) for d in days})
        others = stored.filter(F.col(MONTH).isin(months) & ~F.coalesce(on_days(F.col("date"), days), F.lit(False)))
        fresh, mode = day_parts(hourly.filter(on_days(F.col(DAY), days))).unionByName(others.drop(MONTH)), "dynamic"
    dated = fresh.withColumn(MONTH, F.coalesce(F.date_format("date", "yyyy-MM"), F.lit("none")))
    # One row per day: a single small file for each month.
    dated.repartition(MONTH).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(MONTH).parquet(path)
    return read_hourly(spark, path).drop(MONTH)


def _month(day: date | None) -> str:
    return "none" if day is None else f"{day:%Y-%m}"


def rows_of(parts: DataFrame, days: Sequence[date | None] | None) -> int:
    """How many hours the given days hold, or all."""
    some = parts if days is None else parts.filter(on_days(F.col("date"), days)) if days else parts.limit(0)
    return some.agg(F.sum("n_hours")).first()[0] or 0


def weather_daily(parts: DataFrame) -> DataFrame:
    """Mean, lowest and highest temperature per day, in double, as `gold.weather_daily` gives from hours."""
    return parts.filter(F.col("date").isNotNull()).select(
        "date", F.when(F.col("n_given") > 0, F.col("given_sum") / F.col("n_given")).alias("avg_temp_c"),
        F.col("given_min").alias("min_temp_c"), F.col("given_max").alias("max_temp_c"),
    ).orderBy("date")


def dim_weather(parts: DataFrame) -> DataFrame:
    """As `dims.dim_weather` from hours."""
    two_digits = "decimal(5,2)"

    def mean(total: str, n: str):
        return (F.col(total) / F.when(F.col(n) > 0, F.col(n)).cast("decimal(13,0)")).cast(two_digits)

    return parts.select(
        calendar.date_key(F.col("date")).alias("date_key"), "date", mean("temp_sum", "n_temp").alias("avg_temp_c"),
        F.col("temp_min").cast(two_digits).alias("min_temp_c"), F.col("temp_max").cast(two_digits).alias("max_temp_c"), mean("rh_sum", "n_rh").alias("avg_rh"),
    )


def dim_date(parts: DataFrame) -> DataFrame:
    """As `dims.dim_date` from hours."""
    return dims.calendar_between(parts.agg(F.min("date").alias("first"), F.max("date").alias("last")))
