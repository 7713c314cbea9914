"""SimHash fingerprints of whole texts, and search within a Hamming radius by permuted block tables.

Terms are pairs of neighbouring words (the first word also pairs with the text's beginning), each
weighted by 1 + ln of its count. Every term's 128 hash bits vote with its weight; a fingerprint
holds the signs. The share of differing bits estimates the angle between two texts' term
vectors, so `likeness` is that angle's cosine, not below 0.

Search: a fingerprint is cut into blocks of bits, with a table per block, led by that block. Of two
fingerprints within the radius, one block at least differs in no more than its share of the
radius. A query looks up each of its blocks under all such differences, so the tables find
all. How long the blocks are follows from the number of fingerprints. A pair that several blocks find is
taken from the first of them. Equal fingerprints are one entry; only queries are joined with the tables.

`RADIUS` is set by the texts that the search must reach: of pairs whose 5-word shingles have a
Jaccard similarity of 0.75 or more, half are up to 13 bits apart and 99 of 100 up to 21.

Defined results: a null text counts as empty; texts without words have the fingerprint of
zeros; repeated rows and ids are ordered by a hash of their text and then fingerprinted one by
one; a null doc_id sorts first; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import column, mix, text_slices, words, written

BITS = 128
RADIUS = 23
MOST_KEYS = 20_000
TASK_KEYS = 500_000
BEGIN = np.uint64(0x5851F42D4C957F2D)
SECOND = np.uint64(0x14057B7EF767814F)


def fingerprints(texts: list[str]) -> np.ndarray:
    """Fingerprints as rows of two 64-bit integers."""
    out = np.zeros((len(texts), BITS // 64), dtype=np.uint64)
    for low, _, data, offsets in text_slices(pa.array(texts, pa.large_string())):
        hashes, first, _ = words(data, offsets)
        before = np.concatenate([[BEGIN], hashes[:-1]]) if len(hashes) else hashes
        before[first[:-1][first[:-1] < len(hashes)]] = BEGIN
        with np.errstate(over="ignore"):
            terms = mix(before * np.uint64(3) + hashes)
        for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
            if a == b:
                continue
            found, counts = np.unique(terms[a:b], return_counts=True)
            weight = (1 + np.log(counts)).astype(np.float32)
            votes = np.concatenate([found, mix(found ^ SECOND)]).astype(">u8").view(np.uint8).reshape(2, -1, 8)
            bits = np.unpackbits(votes, axis=2)
            sums = np.concatenate([weight @ bits[0].astype(np.float32), weight @ bits[1].astype(np.float32)])
            signs = sums * 2 > weight.sum()
            out[low + i] = np.packbits(signs).view(">u8")
    return out


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Estimated cosine of the angle between the texts of two rows of fingerprints, 0 to 1."""
    apart = np.bitwise_count(one ^ other).sum(axis=1)
    return np.maximum(np.cos(np.pi * apart / BITS), 0.0)


def hexadecimal(prints: np.ndarray) -> list[str]:
    return [row.astype(">u8").tobytes().hex() for row in prints]


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


ROWS = (
    "kind int, part int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, text string"
)
DONE, FIRST, LAST = 0, 1, 2


def _rows(ids: list[int | None], texts: list[str], prints: np.ndarray, followers: list[str], next_prints: np.ndarray, part: int) -> pa.RecordBatch:
    changed = [edited(t, f) for t, f in zip(texts, followers, strict=True)]
    new = fingerprints(changed)
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array([DONE] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
         pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
         pa.array(hexadecimal(prints), pa.string()), pa.array(hexadecimal(new), pa.string()),
         pa.array(likeness(prints, new)), pa.array(likeness(prints, next_prints)), pa.nulls(n, pa.string())],
        names=[f.split()[0] for f in ROWS.split(", ")],
    )


def _edge(kind: int, part: int, doc_id: int | None, text: str) -> pa.RecordBatch:
    values = {"kind": kind, "part": part, "doc_id": doc_id, "text": text}
    return pa.RecordBatch.from_pylist([values], pa.schema([
        ("kind", pa.int32()), ("part", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string()),
    ]))


def fingerprint_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each document with its fingerprint, that of its edited text, and the likeness of both neighbours.

    Texts are sorted by id in ranges. Within a range, rows are compared as they stream by; only
    the first and last text of each range meet their neighbours in a second, small step.
    """
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit("")))]
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order)

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last: tuple | None = None
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                some = batch.slice(low, 512)
                ids, texts = column(some, "doc_id").to_pylist(), [t or "" for t in column(some, "text").to_pylist()]
                prints = fingerprints(texts)
                if last is None:
                    yield _edge(FIRST, part, ids[0], texts[0])
                else:
                    ids, texts, prints = [last[0], *ids], [last[1], *texts], np.concatenate([last[2], prints])
                last = (ids[-1], texts[-1], prints[-1:])
                if len(ids) > 1:
                    yield _rows(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:], part)
        if last is not None:
            yield _edge(LAST, part, last[0], last[1])

    found = written(ordered.mapInArrow(streamed, ROWS), "fingerprints")
    firsts = found.filter(F.col("kind") == FIRST).select("part", F.col("text").alias("following"))
    # One row per range: small enough for a window without partitions.
    parts = firsts.select("part").withColumn("next", F.coalesce(
        F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ))
    lasts = found.filter(F.col("kind") == LAST).select("part", "doc_id", "text")
    met = lasts.join(parts, "part").drop("part").join(firsts.withColumnRenamed("part", "next"), "next")

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, followers = column(batch, "text").to_pylist(), column(batch, "following").to_pylist()
            yield _rows(column(batch, "doc_id").to_pylist(), texts, fingerprints(texts), followers, fingerprints(followers), -1)

    ends = met.select("doc_id", "text", "following").mapInArrow(closed, ROWS)
    return found.filter(F.col("kind") == DONE).unionByName(ends).drop("kind", "part", "text")


def cuts(radius: int, n: int) -> list[tuple[int, int, int]]:
    """(begin, end, errors) of `n` blocks of bits: within the radius, one block has no more than its errors."""
    errors, more = divmod(radius, n)
    edges = [round(i * BITS / n) for i in range(n + 1)]
    found = [(a, b, errors if i <= more else errors - 1) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
    return [c for c in found if c[2] >= 0]


def looked_up(cut: tuple[int, int, int]) -> int:
    """How many keys a query looks up in the table of a block."""
    begin, end, errors = cut
    return sum(comb(end - begin, k) for k in range(errors + 1))


def best_cuts(radius: int, entries: int) -> list[tuple[int, int, int]]:
    """The blocks with which a query has least to look up and to compare, if fingerprints fill their keys evenly.

    Long blocks mean many keys and few entries for each, so blocks grow with the number of entries.
    """
    options = [cuts(radius, n) for n in range(4, 33)]
    fine = [c for c in options if max(map(looked_up, c)) <= MOST_KEYS] or options[-1:]
    return min(fine, key=lambda c: sum(looked_up(x) * (1 + entries / 2 ** (x[1] - x[0])) for x in c))


def differences(width: int, errors: int) -> list[int]:
    return [sum(1 << k for k in places) for n in range(errors + 1) for places in combinations(range(width), n)]


def halves(fingerprint: Column) -> list[Column]:
    """The fingerprint as two 64-bit integers."""
    a, b, c, d = (F.conv(F.substring(fingerprint, at, 8), 16, 10).cast("long") for at in (1, 9, 17, 25))
    return [F.shiftleft(a, 32).bitwiseOR(b), F.shiftleft(c, 32).bitwiseOR(d)]


def joined(high: Column, low: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def bits(high: Column, low: Column, begin: int, end: int) -> Column:
    """Some of the 128 bits, counted from the highest, as an integer."""
    half = BITS // 2
    if begin < half < end:
        upper = high.bitwiseAND(F.lit((1 << half - begin) - 1))
        return F.shiftleft(upper, end - half).bitwiseOR(F.shiftrightunsigned(low, BITS - end))
    word, behind = (high, half - end) if end <= half else (low, BITS - end)
    return F.shiftrightunsigned(word, behind).bitwiseAND(F.lit((1 << end - begin) - 1))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, fingerprint, n): all fingerprints within the radius of each query, and how many rows have each.

    Both inputs have a column `fingerprint`.
    """
    if not 0 <= radius < BITS // 4:
        raise ValueError(f"radius must be 0 to {BITS // 4 - 1}")
    entries = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))
    blocks = best_cuts(radius, entries.count())
    place = [F.lit(i << 40) for i in range(len(blocks))]
    entries = entries.select(*[h.alias(c) for h, c in zip(halves(F.col("fingerprint")), ("high", "low"), strict=True)], "n")
    keys = F.array(*[p + bits(F.col("high"), F.col("low"), a, b) for p, (a, b, _) in zip(place, blocks, strict=True)])
    table = entries.select("high", "low", "n", F.explode(keys).alias("block"))
    asked = queries.select("fingerprint").distinct()
    # So many tasks as the keys need that queries are multiplied by, however small the queries are themselves.
    asked = asked.repartition(max(1, math.ceil(asked.count() * sum(map(looked_up, blocks)) / TASK_KEYS)))
    asked = asked.select(*[h.alias(c) for h, c in zip(halves(F.col("fingerprint")), ("q_high", "q_low"), strict=True)])

    def keys_under(p: Column, begin: int, end: int, errors: int) -> Column:
        own = bits(F.col("q_high"), F.col("q_low"), begin, end)
        return F.transform(F.lit(differences(end - begin, errors)).cast("array<bigint>"), lambda x: p + own.bitwiseXOR(x))

    keys = F.flatten(F.array(*[keys_under(p, *cut) for p, cut in zip(place, blocks, strict=True)]))
    asked = asked.select("q_high", "q_low", F.explode(keys).alias("block"))
    apart = F.col("q_high").bitwiseXOR(F.col("high")), F.col("q_low").bitwiseXOR(F.col("low"))
    first = F
    for i, (begin, end, errors) in enumerate(blocks):
        first = first.when(F.bit_count(bits(*apart, begin, end)) <= errors, i)
    close = F.bit_count(apart[0]) + F.bit_count(apart[1]) <= radius
    # Spark takes both sides for as small as they were before they were exploded and would broadcast one.
    near = asked.hint("merge").join(table, "block").filter(close & (first == F.shiftright("block", 40)))
    return near.select(joined(F.col("q_high"), F.col("q_low")).alias("query"), joined(F.col("high"), F.col("low")).alias("fingerprint"), "n")
