"""Typed views over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ORDER_TYPES = {
    "order_id": "int",
    "product": "string",
    "quantity": "int",
    "price": "decimal(10,2)",
    "total": "decimal(12,2)",
}


def orders_columns(orders: DataFrame) -> list[str]:
    """The model's columns as SQL over the loaded table, also for a view that is stored."""
    return [f"CAST({c} AS {t}) AS {c}" for c, t in ORDER_TYPES.items()]


def weather_columns(hourly: DataFrame) -> list[str]:
    """Humidity with a fraction goes to the nearest integer, ties to the even one."""
    fractional = isinstance(hourly.schema["rh_pct"].dataType, (T.DoubleType, T.FloatType))
    return [
        "CAST(ts_utc AS TIMESTAMP_NTZ) AS ts_utc",
        "CAST(temp_c AS DECIMAL(5,2)) AS temp_c",
        f"CAST({'rint(rh_pct)' if fractional else 'rh_pct'} AS INT) AS rh_pct",
        "lat",
        "lon",
    ]


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(*orders_columns(orders))


def stg_weather(hourly: DataFrame) -> DataFrame:
    return hourly.selectExpr(*weather_columns(hourly))
