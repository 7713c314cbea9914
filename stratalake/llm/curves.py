"""Approximate nearest neighbours by inner product on shifted space-filling curves.

Each of `CURVES` orderings projects the vectors at random onto a few dimensions, cuts these at
quantiles that are shifted from curve to curve, and follows a Hilbert curve through the cells.
Along a curve, rows are dealt into ranges of keys with about equal numbers of rows. A query looks
into its own range and `REACH` ranges on both sides; what the curves find is merged, and ranked
by the exact inner product of the original vectors.

Largest inner product is turned into nearness on a sphere: vectors are scaled by the largest
length and get one more component that fills them up to length one; queries get a 0 there. That
works for vectors of like length, so each band of lengths (a factor of two; the last holds all
shorter ones) has a scale and curves of its own, and a query looks into all bands.

Projections and key ranges are fitted on a sample of at most `SAMPLE_VALUES` numbers; all rows are
indexed and ranked. Each row has one copy per curve. Ranges are dealt to tasks in blocks of about `BLOCK_ROWS`
rows, so vectors that occur very often do not fill one task; the queries of a block stream past its rows.
A band of less than twice `LEAST_ROWS` rows is one range, which is searched whole.

The share of rows that a query meets is set by curves and ranges, not by a number of rows: in
data without clusters the neighbours of a point are spread over the whole space, and a fixed
window would lose them as the table grows.

Defined results: vectors that are null, empty, zero, of another than the most frequent length
(the shorter on a tie), or that hold null or non-finite components take no part, nor do rows
without an id; rows that share an id are one candidate with the best of their scores; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CURVES = 16
DIMENSIONS, BITS = 16, 3
RANGES, REACH = 40, 1
LEAST_ROWS = 128
BANDS = 8
SAMPLE_VALUES = 1_500_000
BLOCK_ROWS, BLOCK_QUERIES = 8192, 256


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of each cell (rows of coordinates below 2**bits) on the Hilbert curve through all cells.

    Works on all rows at once: from the highest bit down, a coordinate's bit tells whether the
    lower bits of the first axis are mirrored or swapped with that axis; a Gray code ends it.
    """
    axes = [c.astype(np.uint32) for c in cells.T]
    n = len(axes)
    for bit in range(bits - 1, 0, -1):
        lower = np.uint32((1 << bit) - 1)
        for i in range(n):
            on = (axes[i] >> np.uint32(bit)) & np.uint32(1) == 1
            swap = np.where(on, np.uint32(0), (axes[0] ^ axes[i]) & lower)
            axes[0] = np.where(on, axes[0] ^ lower, axes[0]) ^ swap
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, n):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(axes[0])
    for bit in range(bits - 1, 0, -1):
        on = (axes[-1] >> np.uint32(bit)) & np.uint32(1) == 1
        turn = np.where(on, turn ^ np.uint32((1 << bit) - 1), turn)
    keys = np.zeros(len(cells), dtype=np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            keys = keys << np.uint64(1) | ((axis ^ turn) >> np.uint32(bit) & np.uint32(1)).astype(np.uint64)
    return keys.astype(np.int64)


@dataclass
class Curve:
    projection: np.ndarray
    cuts: np.ndarray  # dimensions x (2**bits - 1)
    edges: np.ndarray  # keys at which the next range begins

    def keys(self, points: np.ndarray) -> np.ndarray:
        flat = points @ self.projection
        cells = np.stack([np.searchsorted(c, flat[:, j]) for j, c in enumerate(self.cuts)], axis=1)
        return hilbert_keys(cells, BITS)

    def ranges(self, points: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, self.keys(points), "right")


def on_sphere(vectors: np.ndarray, longest: float) -> np.ndarray:
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(1 - (scaled**2).sum(axis=1), 0.0))
    return np.concatenate([scaled, rest[:, None]], axis=1)


def as_queries(vectors: np.ndarray) -> np.ndarray:
    unit = vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    return np.concatenate([unit, np.zeros((len(unit), 1))], axis=1)


def fit_curves(sample: np.ndarray, longest: float, curves: int, ranges: int, seed: int = 11) -> list[Curve]:
    points = on_sphere(sample, longest)
    rng = np.random.default_rng(seed)
    dims = min(DIMENSIONS, points.shape[1])
    out = []
    for _ in range(curves):
        axes = np.linalg.qr(rng.normal(size=(points.shape[1], dims)))[0]
        flat = points @ axes
        shift = rng.random((dims, 1)) - 0.5
        shares = np.clip((np.arange(1, 2**BITS)[None, :] + shift * 0.9) / 2**BITS, 0, 1)
        curve = Curve(axes, np.stack([np.quantile(flat[:, j], shares[j]) for j in range(dims)]), np.empty(0, np.int64))
        keys = np.sort(curve.keys(points))
        curve.edges = keys[[len(keys) * k // ranges for k in range(1, ranges)]]
        out.append(curve)
    return out


@dataclass
class Slot:
    """A curve through the vectors of a band; its ranges are the places from `base` on."""

    band: int
    longest: float
    curve: Curve | None  # None: one range
    ranges: int
    base: int

    def of_rows(self, vectors: np.ndarray) -> np.ndarray:
        return self.curve.ranges(on_sphere(vectors, self.longest)) if self.curve else np.zeros(len(vectors), np.int64)

    def of_queries(self, vectors: np.ndarray) -> np.ndarray:
        return self.curve.ranges(as_queries(vectors)) if self.curve else np.zeros(len(vectors), np.int64)


def fit_slots(bands: list[tuple[int, int, float]], sample: dict[int, np.ndarray], curves: int, ranges: int) -> list[Slot]:
    """Curves of every band (its number, rows and largest length)."""
    slots: list[Slot] = []
    for band, n, longest in bands:
        own = sample.get(band, np.empty((0, 0)))
        n_ranges = min(ranges, n // LEAST_ROWS, len(own))
        for curve in fit_curves(own, longest, curves, n_ranges) if n_ranges > 1 else [None]:
            base = slots[-1].base + slots[-1].ranges if slots else 0
            slots.append(Slot(band, longest, curve, max(n_ranges, 1), base))
    return slots


def usable(rows: DataFrame, vector_id: str, vector: str) -> tuple[DataFrame, int]:
    """(vec_id, vector) of the rows that take part, and the number of components; 0 without any."""
    value = F.col(vector)
    if rows.select(vector).dtypes[0][1] != "array<float>":
        value = value.cast("array<double>")
    fine = rows.select(F.col(vector_id).cast("long").alias("vec_id"), value.alias("vector")).filter(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    )
    most = fine.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return (fine.filter(F.size("vector") == most["n"]), most["n"]) if most else (fine, 0)


def _matrix(batch: pa.RecordBatch, n: int) -> np.ndarray:
    """Vectors as they are stored, in single or double precision."""
    lists = batch.column(batch.schema.get_field_index("vector"))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, n)


def neighbours(rows: DataFrame, is_query: Column, k: int, vector_id: str = "vec_id", vector: str = "embedding",
               curves: int = CURVES, ranges: int = RANGES, reach: int = REACH) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row, itself left out.

    `is_query` is a condition on `vec_id`.
    """
    out = "query_id long, rank int, vec_id long, score double"
    fine, n_components = usable(rows, vector_id, vector)
    if not n_components:
        return rows.sparkSession.createDataFrame([], out)
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    stored = np.float32 if fine.dtypes[1][1] == "array<float>" else np.float64
    longest = fine.agg(F.max(length)).first()[0]
    band = F.least(F.floor(F.log2(F.lit(longest) / length)), F.lit(BANDS - 1)).cast("int")
    marked = fine.withColumn("query", F.coalesce(is_query, F.lit(False))).withColumn("band", band)
    bands = [tuple(r) for r in marked.groupBy("band").agg(F.count(F.lit(1)), F.max(length)).orderBy("band").collect()]
    share = F.lit(0)
    for b, n, _ in bands:
        share = F.when(F.col("band") == b, round(1e6 * min(1.0, SAMPLE_VALUES / n_components / len(bands) / n))).otherwise(share)
    sampled = marked.filter(F.expr("pmod(xxhash64(vec_id), 1000000)") < share).select("band", "vec_id", "vector").toPandas().sort_values("vec_id")
    sample = {int(b): np.stack(some["vector"].to_list()).astype(np.float64) for b, some in sampled.groupby("band")}
    slots = fit_slots(bands, sample, curves, ranges)
    n_places = slots[-1].base + slots[-1].ranges

    def held(batch: pa.RecordBatch, name: str) -> np.ndarray:
        return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)

    def places(vectors: np.ndarray, own_band: np.ndarray) -> Iterator[tuple[Slot, np.ndarray, np.ndarray]]:
        """Per curve: the rows of its band, and their ranges."""
        for slot in slots:
            own = np.flatnonzero(own_band == slot.band)
            if len(own):
                yield slot, own, slot.of_rows(vectors[own])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(n_places, dtype=np.int64)
        for batch in batches:
            for slot, _, at in places(_matrix(batch, n_components).astype(np.float64), held(batch, "band")):
                sums += np.bincount(slot.base + at, minlength=n_places)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_places)), pa.array(sums)], names=["place", "n"])

    # One row per curve and range.
    sums = marked.mapInArrow(counted, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    rows_of = np.zeros(n_places, dtype=np.int64)
    rows_of[sums["place"]] = sums["n"]
    blocks = np.maximum(1, -(-rows_of // BLOCK_ROWS))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A copy of each row for every curve, and of each query for every block of rows around it."""

        def copies(ids: np.ndarray, vectors: np.ndarray, at: np.ndarray, place: np.ndarray, block: np.ndarray, query: bool) -> pa.RecordBatch:
            data = np.ascontiguousarray(vectors[at])
            width = data.itemsize * n_components
            values = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((np.arange(len(at) + 1) * width).astype(np.int32)), pa.py_buffer(data)])
            return pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array(block), pa.array(np.full(len(at), query)), pa.array(ids[at]), values], names=["place", "block", "query", "vec_id", "vector"]
            )

        for batch in batches:
            ids, vectors = held(batch, "vec_id"), _matrix(batch, n_components)
            exact = vectors.astype(np.float64)
            for slot, own, at in places(exact, held(batch, "band")):
                place = slot.base + at
                yield copies(ids, vectors, own, place, (ids[own] * 2654435761 >> 7) % blocks[place], False)
            asked = np.flatnonzero(held(batch, "query"))
            for slot in slots if len(asked) else ():
                at = slot.of_queries(exact[asked])
                for j in range(-reach, reach + 1):
                    inside = (at + j >= 0) & (at + j < slot.ranges)
                    place = slot.base + at[inside] + j
                    times = blocks[place]
                    turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    yield copies(ids, vectors, np.repeat(asked[inside], times), np.repeat(place, times), turn, True)

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k best of a block's rows for each query that passes by; rows come before queries."""
        last, pool, rows, single = None, np.empty(0, np.int64), np.empty((0, n_components)), True
        slack = 1e-9 * longest * longest
        for batch in batches:
            names = np.stack([held(batch, c).astype(np.int64) for c in ("place", "block", "query")])
            ids, lists = held(batch, "vec_id"), batch.column(batch.schema.get_field_index("vector"))
            size = np.dtype(stored).itemsize * n_components
            data = np.frombuffer(lists.buffers()[2], np.uint8)[lists.offset * size : (lists.offset + len(ids)) * size]
            vectors = data.view(stored).reshape(-1, n_components).astype(np.float64)
            cuts = [0, *(np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1).tolist(), len(ids)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if low == high:
                    continue
                place, block, query = names[:, low].tolist()
                if (place, block) != last:
                    last, pool, rows = (place, block), np.empty(0, np.int64), np.empty((0, n_components))
                if not query:
                    pool, rows = np.concatenate([pool, ids[low:high]]), np.concatenate([rows, vectors[low:high]])
                    single = len(np.unique(pool)) == len(pool)
                    continue
                for begin in range(low, high, BLOCK_QUERIES) if len(pool) else ():
                    own = slice(begin, min(begin + BLOCK_QUERIES, high))
                    found = best_of(ids[own], vectors[own], pool, rows, single, slack)
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["query_id", "vec_id", "score"])

    def best_of(own: np.ndarray, queries: np.ndarray, pool: np.ndarray, rows: np.ndarray, single: bool, slack: float) -> list[tuple]:
        found = []
        rough = queries @ rows.T
        for i, q in enumerate(own):
            others = pool != q
            line = rough[i]
            if single and others.sum() > k:
                least = np.partition(line[others], -k)[-k] - slack
                others &= line >= least
            some = np.flatnonzero(others)
            if not len(some):
                continue
            exact = (rows[some] * queries[i]).sum(axis=1)
            best = np.lexsort((pool[some], -exact))
            if not single:
                best = best[np.sort(np.unique(pool[some][best], return_index=True)[1])]
            best = best[:k]
            found.append((np.full(len(best), q), pool[some][best], exact[best]))
        return found

    rows_of_blocks = marked.mapInArrow(dealt, "place long, block long, query boolean, vec_id long, vector binary")
    streamed = rows_of_blocks.repartition("place", "block").sortWithinPartitions("place", "block", "query", "vec_id")
    found = streamed.mapInArrow(ranked, "query_id long, vec_id long, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
