"""Warehouse tables and silver Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str | None = None,
    lower: str | None = None, upper: str | None = None, partitions: int = 1, **properties: str,
) -> DataFrame:
    """Database table; give a column with bounds to read it as that many ranges at once.

    The bounds only place the cuts: rows outside them are read too.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
            numPartitions=partitions,
        )
    return reader.load()


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver Parquet; a missing path fails here, before any load starts."""
    return spark.read.parquet(path)
