"""Synthetic sales rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.constants import SYNTHETIC_PRODUCTS


def synthetic_sales(ids: DataFrame, seed: int = 0, id_column: str = "order_id") -> DataFrame:
    """One sales row per id: product out of four, quantity 1-5, price 10.00-100.00.

    Values come from a hash of seed and id, so they do not depend on partitioning and a
    lost task recomputes the same rows.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_column).cast("string")))
    drawn = ids.select(F.col(id_column).cast("bigint").alias("order_id"), digest.alias("digest"))

    def draw(start: int):
        """32 bits of the digest as a number from 0 up to 2^32."""
        return F.conv(F.substring("digest", start, 8), 16, 10).cast("bigint")

    products = F.array(*[F.lit(p) for p in SYNTHETIC_PRODUCTS])
    return drawn.select(
        "order_id",
        F.get(products, (draw(1) % len(SYNTHETIC_PRODUCTS)).cast("int")).alias("product"),
        (draw(9) % 5 + 1).alias("quantity"),
        F.round(10 + 90 * (draw(17) / F.lit(float(2**32))), 2).alias("price"),
    )


def synthetic_ids(spark: SparkSession, n: int = 1000) -> DataFrame:
    return spark.range(1, n + 1).withColumnRenamed("id", "order_id")
