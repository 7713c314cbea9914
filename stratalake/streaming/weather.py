"""Every newly landed weather file, merged into silver."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.constants import WEATHER_DOCUMENT, WEATHER_GLOB
from stratalake.plans.silver import merge_weather
from stratalake.session import require_ansi, sized_shuffles
from stratalake.sources.listing import total_bytes
from stratalake.sources.weather_files import with_file, with_row


def start_merge(
    spark: SparkSession, landing: str, silver_path: str, checkpoint: str,
    multi_line: bool = True, max_files: int | None = None, keep: str = "first",
) -> StreamingQuery:
    """Starts a run over the files that arrived since the last one; it ends by itself.

    What has been seen lives in the silver table, so late hours of any age are merged and no
    watermark is needed. A batch that is tried again after a failure changes nothing.
    """
    require_ansi(spark)
    reader = (
        spark.readStream.schema(WEATHER_DOCUMENT).option("multiLine", multi_line)
        .option("mode", "FAILFAST")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    documents = with_file(reader.json(f"{landing.rstrip('/')}/{WEATHER_GLOB}"), F.col("_metadata.file_size").alias("_bytes"))

    def merge_batch(batch: DataFrame, _: int) -> None:
        # The batch is parsed once; its files' sizes and its documents come from disk after that.
        parsed = with_row(batch).persist(StorageLevel.DISK_ONLY)
        try:
            sizes = parsed.groupBy("_file").agg(F.max("_bytes").alias("length"))
            with sized_shuffles(spark, total_bytes(sizes)):
                merge_weather(parsed.drop("_bytes"), silver_path, keep)
        finally:
            parsed.unpersist()

    return (
        documents.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
