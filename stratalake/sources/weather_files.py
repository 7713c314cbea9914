"""Raw weather documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.constants import WEATHER_DOCUMENT, WEATHER_FILE, WEATHER_GLOB
from stratalake.sources.listing import exact_path, file_of, list_files, newest_name


def weather_listing(spark: SparkSession, folder: str) -> DataFrame:
    return list_files(spark, folder, WEATHER_GLOB, WEATHER_FILE)


def newest_weather_file(spark: SparkSession, folder: str) -> str:
    return newest_name(weather_listing(spark, folder))


def read_documents(
    spark: SparkSession, folder: str, name: str | None = None, multi_line: bool = True
) -> DataFrame:
    """Documents of the raw file `name`, or of all raw files, with their place.

    `multi_line` reads one document per file, as an API delivers it. Turn it off for files
    with one document per line, which Spark can split.
    """
    documents = (
        spark.read.schema(WEATHER_DOCUMENT).option("mode", "FAILFAST")
        .option("multiLine", multi_line).json(f"{folder.rstrip('/')}/{exact_path(name) if name else WEATHER_GLOB}")
    )
    return with_row(with_file(documents))


def with_file(documents: DataFrame, *more: Column) -> DataFrame:
    """Adds file and split, which order the documents, and `more` of the reader's metadata."""
    return documents.select(
        "*",
        file_of("_metadata.file_path", WEATHER_FILE).alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        *more,
    )


def with_row(documents: DataFrame) -> DataFrame:
    """Adds the order inside a split. Not available on a stream, only on its batches."""
    return documents.withColumn("_row", F.monotonically_increasing_id())
