"""Sales fact and the per-product mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.numeric import exact_mean
from stratalake.functions.text import surrogate_key


def fact_sales(stg_orders: DataFrame) -> DataFrame:
    """One row per order line: a projection, so nothing is shuffled."""
    return stg_orders.select(
        surrogate_key(F.col("product")).alias("product_key"),
        "order_id",
        F.col("quantity").cast("int").alias("qty"),
        F.col("price").cast("decimal(12,2)").alias("unit_price_eur"),
        F.col("total").cast("decimal(12,2)").alias("revenue_eur"),
    )


def fct_sales_by_product(stg_orders: DataFrame) -> DataFrame:
    """Sales per product."""
    return stg_orders.groupBy("product").agg(
        F.count("*").alias("n_orders"),
        F.sum("quantity").alias("qty"),
        F.sum("total").alias("revenue"),
        exact_mean(F.col("price")).alias("avg_price"),
    )


def best_first(mart: DataFrame) -> DataFrame:
    """Rows in order for readers; a product without any known total comes on top."""
    return mart.orderBy(F.desc_nulls_first("revenue"))
