"""Daily weather for the gold file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.numeric import nan_to_null


def weather_daily(hourly: DataFrame) -> DataFrame:
    """Mean, lowest and highest temperature per day, in double; hours without a time are left out."""
    temperature = nan_to_null(F.col("temp_c"))
    dated = hourly.select(F.to_date("ts_utc").alias("date"), temperature.alias("temp_c"))
    return dated.filter(F.col("date").isNotNull()).groupBy("date").agg(
        F.avg("temp_c").alias("avg_temp_c"),
        F.min("temp_c").alias("min_temp_c"),
        F.max("temp_c").alias("max_temp_c"),
    ).orderBy("date")
