"""Helpers that several operators share: tables, written intermediates, words and their hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.session import scratch_path

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
ODD = np.uint64(0xD6E8FEB86659FD93)
SLICE_BYTES = 1024**2


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes the rows to the shared scratch folder and reads them back, which cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder_of_id(divisor: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id's decimal digits, modulo `divisor`: how ids are dealt into folds."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit integer over all its bits (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * ODD
    x ^= x >> np.uint64(29)
    x = x * GOLDEN
    return x ^ (x >> np.uint64(32))


_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
SPACE = np.isin(_BYTES, [0x20, *range(0x09, 0x0E)])
LEADING = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
LONG_RUN = 512


def runs(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray, alone: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte of each run of bytes that are not `apart`, in texts that lie one after the other.

    Text `i` covers `data[offsets[i]:offsets[i + 1]]`; no run goes on into the next text. A byte
    that equals `alone` is a run by itself.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inner = ~apart[data]
    begins, ends = inner.copy(), inner.copy()
    cut = ~inner
    if alone is not None:
        cut |= data == alone
        begins[1:] &= cut[:-1] | cut[1:]
    else:
        begins[1:] &= cut[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins[edges] = inner[edges]
    ends[:-1] &= ~inner[1:] | begins[1:]
    return np.flatnonzero(begins), np.flatnonzero(ends)


def run_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes, eight bytes at a step, every step a bijection of the state."""
    if not len(starts):
        return np.empty(0, np.uint64)
    eight = np.ndarray(len(data), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    left = stops - starts + 1
    hashes = mix(left.astype(np.uint64) * GOLDEN + ODD)
    long = np.flatnonzero(left > LONG_RUN)
    for i in long.tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : stops[i] + 1].tobytes())
    rest, at = (np.flatnonzero(left <= LONG_RUN), starts[left <= LONG_RUN]) if len(long) else (slice(None), starts)
    left = left[rest]
    with np.errstate(over="ignore"):
        while len(left):
            block = eight[at] & LEADING[np.minimum(left, 8)]
            hashes[rest] = mix((hashes[rest] ^ block) + GOLDEN)
            more = np.flatnonzero(left > 8)
            rest, at, left = more if isinstance(rest, slice) else rest[more], at[more] + 8, left[more] - 8
    return hashes


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after the other in `data`.

    A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. The words of text
    `i` are `hashes[first[i]:first[i + 1]]`. Returns the hashes, `first`, and the byte at which
    each word begins.
    """
    starts, stops = runs(data, offsets, SPACE)
    return run_hashes(LOWER[data], starts, stops), np.searchsorted(starts, offsets), starts


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts a text column into runs of rows of about `most` bytes: (from, to, bytes, offsets).

    A single longer text makes a run of its own. Nulls are empty texts.
    """
    n = len(column)
    if not n:
        return
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, 8 * column.offset)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        high = min(high, n)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def letters() -> np.ndarray:
    """For every code point: is it a letter?"""
    if not len(_LETTERS):
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


_LETTERS: list[np.ndarray] = []


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, each between two zeros, and where each text's first zero stands."""
    low = [(t or "").lower() for t in texts]
    codes = np.frombuffer("\0".join(["", *low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.cumsum([0, *(len(t) + 1 for t in low)])


def text_runs(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Cuts a batch into runs of rows with about `most` bytes of text, longer texts alone."""
    for low, high, _, _ in text_slices(column(batch, text), most):
        part = batch.slice(low, high - low)
        yield part, column(part, text).to_pylist()


def claim(owner: str, forget: Callable[[], None] | None = None) -> None:
    """Makes `owner` the one whose large tables this worker keeps; those of others are dropped.

    Workers serve one stage after the other, and what one of them has kept is of no use to the next.
    """
    others = [o for o in _KEPT if o != owner]
    for other in others:
        _KEPT.pop(other)()
    if others:
        # What is free goes back to the system, since the JVM beside this worker may need it.
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)
    if forget:
        _KEPT[owner] = forget


_KEPT: dict[str, Callable[[], None]] = {}


def with_new_columns(docs: DataFrame, keep: list[str | Column] | None, text: str, new: list[tuple[str, str]],
                     judged: Callable[[list[str | None]], list[pa.Array]]) -> DataFrame:
    """The chosen columns of each row, or all, with columns that `judged` derives from runs of texts.

    `new` has names and types of these columns; a column of the input with such a name is replaced.
    Only the text goes to Python, and only the new columns come back.
    """
    names = [n for n, _ in new]
    schema = T.StructType()
    for name, kind in new:
        schema = schema.add(name, kind)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in columns:
            slices = [texts.slice(low, high - low) for low, high, _, _ in text_slices(texts)] or [texts]
            yield pa.concat_arrays([pa.StructArray.from_arrays(judged(some.to_pylist()), names=names) for some in slices])

    # Not to be called once more for a filter on what it gives.
    derived = F.arrow_udf(run, schema).asNondeterministic()(F.col(text)).alias(HIDDEN)
    rows = docs.select(*([c for c in docs.columns if c == text or c not in names] if keep is None else keep), derived)
    return rows.select(*[c for c in rows.columns if c != HIDDEN], *[F.col(f"{HIDDEN}.{n}").alias(n) for n in names])


HIDDEN = "__new"
