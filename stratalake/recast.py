"""The driver's tables in the shape of the library's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.constants import REQUIRED_SALES_COLUMNS

HOURS_PER_DOCUMENT = 168
LATITUDE, LONGITUDE = 52.5, 13.25
# Row order of the recast sales, standing in for the order of rows in a file.
SALES_ORDER = ("l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_partkey")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str, *carry: str) -> DataFrame:
    """lineitem with the brand and price of its part; the size of `part` decides the join."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("p_brand").alias("product"),
        F.col("l_quantity").alias("quantity"),
        F.col("p_retailprice").alias("price"),
        *carry,
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded `orders` table, with the computed total."""
    return sales(spark, sf_dir).withColumn("total", F.col("price") * F.col("quantity"))


def sales_text(spark: SparkSession, sf_dir: str, given_total: bool) -> DataFrame:
    """Raw sales as text cells, with or without the column `total`."""
    rows = sales(spark, sf_dir, "l_extendedprice").withColumnRenamed("l_extendedprice", "total")
    names = [*REQUIRED_SALES_COLUMNS, *(["total"] if given_total else [])]
    return rows.select(*[F.col(c).cast("string").alias(c) for c in names])


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded `weather_hourly` table."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("ts_utc"),
        F.col("value").alias("temp_c"),
        F.get_json_object("props", "$.k").cast("bigint").alias("rh_pct"),
        F.lit(LATITUDE).alias("lat"),
        F.lit(LONGITUDE).alias("lon"),
    )


def documents(events: DataFrame) -> DataFrame:
    """Weather documents of up to 168 events each, hours in time order.

    `event_id` is unique, so the bound on a document's size holds for any amount of events.
    """
    hour = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"),
        "event_id",
        F.col("value").alias("temperature_2m"),
        F.get_json_object("props", "$.k").cast("double").alias("relative_humidity_2m"),
    )
    grouped = events.groupBy(
        F.floor(F.col("event_id") / HOURS_PER_DOCUMENT).cast("bigint").alias("document")
    ).agg(F.sort_array(F.collect_list(hour)).alias("hours"))
    arrays = [F.col(f"hours.{n}").alias(n) for n in ("time", "temperature_2m", "relative_humidity_2m")]
    return grouped.select(
        "document",
        F.lit(LATITUDE).alias("latitude"),
        F.lit(LONGITUDE).alias("longitude"),
        F.struct(*arrays).alias("hourly"),
    )


def write_raw_csv(rows: DataFrame, folder: str, name: str, order: tuple[str, ...]) -> None:
    """Raw sales file `name`, as part files whose order is the given row order."""
    columns = [c for c in rows.columns if c not in SALES_ORDER]
    rows.orderBy(*order).select(*columns).write.option("header", True).csv(f"{folder}/{name}")
