"""Sharding by extendible hashing.

A row's place follows from the leading bits of a 60-bit hash of its key. A bucket is a prefix of
bits; it splits on one more bit only if its rows exceed the byte limit, so shards have different
depths and the directory maps each prefix of the deepest bits to its bucket.

The directory is built from a table of byte sums per cell, a cell being a prefix a few bits
longer than the mean shard needs. Only cells that are still too large are counted again with
more bits. Rows themselves are not moved for that, and nothing is collected but two numbers.

Defined results: a null text has 0 bytes; rows that share a key (a null key is one too) share a
shard, and such a shard exceeds the limit only if that one key does (`oversize`); an empty table
has no shards; columns of the input that are not asked for are not carried.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import written

HASH_BITS = 60
SHARD_BYTES = 2**20
SPARE_BITS = 4
MORE_BITS = 8


def key_hash(key: Column) -> Column:
    """The first 60 bits of the key text's md5, as a non-negative number."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def prefix(hashed: Column, depth: Column) -> Column:
    """The leading `depth` bits, as text of 0 and 1."""
    return F.lpad(F.bin(hashed), HASH_BITS, "0").substr(F.lit(1), depth)


def _leading(hashed: Column, bits: int) -> Column:
    return F.shiftright(hashed, HASH_BITS - bits)


def _leaves(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """(depth, bucket, shard_bytes) of the buckets of low to high bits that fit, and whose parent does not."""
    up = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high)))).withColumn(
        "bucket", F.expr(f"shiftright(cell, {high} - depth)")
    )
    sums = up.groupBy("depth", "bucket").agg(F.sum("n_bytes").alias("shard_bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
    # A single key can't be split further.
    sums = sums.withColumn("fits", (F.col("shard_bytes") <= limit) | (F.col("low") == F.col("high")))
    split = sums.filter(~F.col("fits")).select((F.col("depth") + 1).alias("depth"), F.explode(
        F.array(F.col("bucket") * 2, F.col("bucket") * 2 + 1)).alias("bucket"))
    fitting = sums.filter("fits").select("depth", "bucket", "shard_bytes")
    return fitting.join(split, ["depth", "bucket"]).unionByName(fitting.filter(F.col("depth") == low))


def directory(rows: DataFrame, limit: int, most_bits: int = HASH_BITS) -> list[tuple[int, DataFrame]]:
    """Directory tables, each with the bits of its cells: (cell, depth, shard_bytes, oversize).

    `rows` has columns hashed and n_bytes. A later table holds only cells that lie below prefixes
    for which no earlier one has an entry.
    """
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    bits = min(most_bits, max(0, math.ceil(math.log2(max(total, 1) / limit))) + SPARE_BITS)
    tables, before, open_rows = [], 0, rows
    while True:
        cells = open_rows.groupBy(_leading(F.col("hashed"), bits).alias("cell")).agg(
            F.sum("n_bytes").alias("n_bytes"), F.min("hashed").alias("low"), F.max("hashed").alias("high")
        )
        # Every slot of the directory that a bucket owns points to it.
        slots = F.expr(f"sequence(0L, shiftleft(1L, {bits} - depth) - 1)")
        found = _leaves(cells, before, bits, limit).withColumn("slot", F.explode(slots)).select(
            (F.expr(f"shiftleft(bucket, {bits} - depth)") + F.col("slot")).alias("cell"), "depth", "shard_bytes",
            (F.col("shard_bytes") > limit).alias("oversize"),
        )
        tables.append((bits, found))
        too_large = cells.filter((F.col("n_bytes") > limit) & (F.col("low") != F.col("high"))).select("cell")
        if bits >= most_bits or too_large.isEmpty():
            return tables
        open_rows = open_rows.withColumn("cell", _leading(F.col("hashed"), bits)).join(too_large, "cell", "left_semi").drop("cell")
        before, bits = bits + 1, min(most_bits, bits + MORE_BITS)


def assign(docs: DataFrame, keep: list[str], limit: int = SHARD_BYTES, key: str = "doc_id", text: str = "text", most_bits: int = HASH_BITS) -> DataFrame:
    """The chosen columns of each row with n_bytes, depth, shard (its bits), shard_bytes and oversize."""
    sized = docs.select(*keep, key_hash(F.col(key)).alias("hashed"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    # Texts are measured once; what is written is small, unless the caller carries whole rows along.
    if text not in keep:
        sized = written(sized, "sized_rows")
    parts, rest = [], sized
    tables = directory(sized.select("hashed", "n_bytes") if text not in keep else written(sized.select("hashed", "n_bytes"), "sized_keys"), limit, most_bits)
    for i, (bits, table) in enumerate(tables):
        placed = rest.withColumn("cell", _leading(F.col("hashed"), bits)).join(table, "cell", "left")
        last = i == len(tables) - 1
        parts.append(placed if last else placed.filter(F.col("depth").isNotNull()))
        rest = placed.filter(F.col("depth").isNull()).select(*keep, "hashed", "n_bytes")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*keep, "n_bytes", F.col("depth").cast("int").alias("depth"), prefix(F.col("hashed"), F.col("depth")).alias("shard"), "shard_bytes", "oversize")


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, key: str = "doc_id", text: str = "text") -> None:
    """Writes the rows as Parquet, a folder per shard; every shard is gathered in one task and fits the limit."""
    carried = [c for c in docs.columns if c not in {"depth", "shard", "shard_bytes", "oversize", "n_bytes"}]
    assign(docs, carried, limit, key, text).repartition("shard").write.partitionBy("shard").parquet(path)
