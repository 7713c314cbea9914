"""Product, calendar and weather dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import calendar
from stratalake.functions.numeric import exact_mean
from stratalake.functions.text import surrogate_key


def dim_product(stg_orders: DataFrame) -> DataFrame:
    """One row per product. The key is hashed once per product, after aggregation."""
    prices = stg_orders.groupBy("product").agg(
        exact_mean(F.col("price")).cast("decimal(12,2)").alias("avg_price")
    )
    return prices.select(surrogate_key(F.col("product")).alias("product_key"), "product", "avg_price")


def dim_date(stg_weather: DataFrame) -> DataFrame:
    """Every day between the first and the last hour, gaps included; no rows if there are none."""
    span = stg_weather.agg(
        F.to_date(F.min("ts_utc")).alias("first"), F.to_date(F.max("ts_utc")).alias("last")
    )
    return calendar_between(span)


def calendar_between(span: DataFrame) -> DataFrame:
    """Every day from `first` to `last` of the one row of `span`."""
    days = span.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("date"))
    day = F.col("date")
    return days.select(
        calendar.date_key(day).alias("date_key"),
        day,
        calendar.iso_weekday(day).alias("weekday"),
        calendar.weekday_name(day).alias("weekday_name"),
        F.month(day).alias("month"),
        calendar.month_name(day).alias("month_name"),
        F.year(day).alias("year"),
        calendar.is_weekend(day).alias("is_weekend"),
    )


def dim_weather(stg_weather: DataFrame) -> DataFrame:
    """Daily temperature and humidity, for days with data only."""
    two_digits = "decimal(5,2)"
    daily = stg_weather.groupBy(F.to_date("ts_utc").alias("date")).agg(
        exact_mean(F.col("temp_c")).cast(two_digits).alias("avg_temp_c"),
        F.min("temp_c").cast(two_digits).alias("min_temp_c"),
        F.max("temp_c").cast(two_digits).alias("max_temp_c"),
        exact_mean(F.col("rh_pct")).cast(two_digits).alias("avg_rh"),
    )
    return daily.select(calendar.date_key(F.col("date")).alias("date_key"), "*")


def by_date(dimension: DataFrame) -> DataFrame:
    """Rows in order for readers; stored tables have none."""
    return dimension.orderBy(F.asc_nulls_last("date"))
