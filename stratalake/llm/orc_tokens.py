"""Token ids as ORC files in ascending document order.

Ids are integer lists, so ORC's run-length encoding packs them to the bits they need. Every file
has row indexes per `INDEX_ROWS` rows and a Bloom filter on `doc_id`: a search for documents
reads the footers and then only the row groups that can hold them, and files and stripes are
read in parallel. Rows are sorted by document id (and a hash of the text, for repeated ids)
across and within files; `shard` numbers the files' ranges in that order and `start` counts the
ids before a document in its shard, so global positions need one small sum per shard.

Defined results: a null text counts as empty and has the end id alone; a null doc_id sorts
first; repeated rows are kept one by one; an empty table gives files without rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import column
from stratalake.llm.tokens import END_ID, crc32, encoder

INDEX_ROWS = 1000
STRIPE_BYTES = 64 * 1024**2
SCHEMA = "shard int, doc_id long, start long, n_tokens long, ids array<int>"


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, text: str = "text") -> None:
    """Encodes every whole text, with the end id behind it, and writes the files."""
    order = ["doc_id", F.xxhash64(text)]
    ordered = docs.select("doc_id", text).repartitionByRange(*order).sortWithinPartitions(*order)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path).encode, END_ID.to_bytes(4, "little")
        shard, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                ids = [raw + end for raw in encode([t or "" for t in column(part, text).to_pylist()])]
                sizes = np.array([len(raw) // 4 for raw in ids], dtype=np.int64)
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                    pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))]),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sizes), shard, np.int32)), column(part, "doc_id").cast(pa.int64()),
                     pa.array(start + ends - sizes), pa.array(sizes), lists],
                    names=["shard", "doc_id", "start", "n_tokens", "ids"],
                )
                start += int(ends[-1])

    writer = ordered.mapInArrow(encoded, SCHEMA).write
    options = {
        "orc.compress": "ZSTD", "orc.create.index": "true", "orc.row.index.stride": str(INDEX_ROWS),
        "orc.stripe.size": str(STRIPE_BYTES), "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
    }
    writer.options(**options).orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """The files' rows; with `doc_ids`, those documents, found by statistics and Bloom filters."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(list(doc_ids)))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents, from the ids in the files."""
    rows = read_tokens(spark, path)
    sums = rows.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = column(batch, "ids")
            ends = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            sums = [crc32(ids[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "shard"), column(batch, "doc_id"), column(batch, "start"),
                 pa.array(np.diff(ends)), pa.array(sums, pa.int64())],
                names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"],
            )

    found = rows.drop("n_tokens").mapInArrow(digests, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return found.join(bases, "shard").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
