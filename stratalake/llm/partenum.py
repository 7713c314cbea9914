"""Join of texts by the Jaccard similarity of their word shingles, with PartEnum signatures.

A text's set has its distinct shingles of five lower-cased words; with fewer words, the whole
sequence is the one shingle. Two texts link if the similarity reaches the threshold.

Sizes fall into bands [2^b, 2^(b+1)). Sets that link have sizes of one band or of two
neighbouring ones, so each set is signed for its own band and, if a larger partner can reach it,
for the next. For a band the domain of all shingles is partitioned by hash. Sets of a and b
shingles that link differ in at most k = (1 - t) / (1 + t) * (a + b) shingles, hence in at most k
partitions. With the partitions that a set occupies in one fixed order, the first k + s of two
such sets have s equal ones in common. So subsets of s of a set's first k + s partitions are
enumerated, and a subset's contents are a signature: linked sets share one. s is 2 in bands of
short texts, where it costs little, and 1 above. A set that occupies fewer partitions than k + s
also enumerates the smaller subsets down to the empty one, which keeps the guarantee. Above the
short bands the order is followed for another tenth of the set's size: linked sets then share
that many signatures, so a set that shares fewer with all others together has no link, and a set
may leave the clusters with which it shares least.

Any fixed order is right. Partitions that hold only frequent shingles (passages that many texts
share) come last, so they are hardly ever signatures. Which shingles are frequent is estimated
on a sample of `SAMPLE_ROWS` texts: it changes the work, never the result.

What shares a signature forms a cluster, named by the smallest id among the sharers. Clusters
with the same name are one, and within a cluster all pairs that are not yet connected are
compared exactly, through an inverted index of the texts' shingles. Large clusters are dealt
into blocks, and each pair of blocks is a task of its own. Rows of frequent signatures are dealt
by signature and id; their smallest id comes from a sum with partial sums, and the join that
returns it is one that Spark splits. Copies within a task are signed once. Links leave a task as
a spanning forest, and components come from alternating large-star and small-star steps on
written tables.

`linked_documents` also counts every link. A pair that several clusters hold is counted in the
first of them, so a task sends one sum per document and no pairs; copies signed once count with
their number.

Defined results: null texts and texts without words have an empty set and no links; equal ids
are one document, whose texts all count; rows without an id have no component and no links;
every input row gives one output row; an empty table gives none; other columns are not looked at.
A row's number of links is that of the other rows with an id whose texts link with its own, copies
and rows of its id among them; rows without an id have none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import claim, column, mix, text_slices, words, written

WORDS = 5
THRESHOLD = (75, 100)
SAMPLE_ROWS = 8000
SAMPLE_LEAST = 3
MOST_FREQUENT = 500_000
TABLE_BITS = 23
SHORT_BAND = 15
SURPLUS = 10
BLOCK = 1024
BROADCAST_BYTES = 32 * 1024**2
STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, first, _ = words(data, offsets)
    n = len(hashes)
    steps = mix(np.arange(1, width + 1, dtype=np.uint64) * STEPS[0]) | np.uint64(1)
    with np.errstate(over="ignore"):
        sums = np.zeros(max(n - width + 1, 0), dtype=np.uint64)
        for k in range(width):
            sums += hashes[k : k + len(sums)] * steps[k]
        shingles = mix(sums)
        sets = []
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= width:
                sets.append(np.unique(shingles[a : b - width + 1]))
            elif b > a:
                whole = (hashes[a:b] * steps[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a) * STEPS[1]
                sets.append(mix(np.array([whole])))
            else:
                sets.append(np.empty(0, np.uint64))
    return sets


class Signer:
    """Signatures for one threshold (numerator, denominator), which is at least a half."""

    def __init__(self, threshold: tuple[int, int] = THRESHOLD, frequent: np.ndarray | None = None):
        self.top, self.bottom = threshold
        if not 2 * self.top >= self.bottom >= self.top > 0:
            raise ValueError("the threshold must be from 0.5 to 1")
        self.frequent = np.zeros(2**TABLE_BITS, dtype=bool)
        if frequent is not None:
            self.frequent[frequent & np.uint64(2**TABLE_BITS - 1)] = True

    def apart(self, a: int, b: int) -> int:
        """Most shingles in which linked sets of these sizes differ."""
        return (self.bottom - self.top) * (a + b) // (self.bottom + self.top)

    def partitions(self, band: int) -> int:
        high = 2 ** (band + 1) - 1
        return 64 if high <= SHORT_BAND else math.ceil(1.3 * (self.apart(high, high) + 1)) + 2

    def roles(self, size: int) -> list[tuple[int, int]]:
        """(band, k) for which a set of this size is signed."""
        band = size.bit_length() - 1
        high, partner = 2 ** (band + 1) - 1, size * self.bottom // self.top
        own = [(band, self.apart(size, min(high, partner)))]
        return own + [(band + 1, self.apart(size, partner))] if partner > high else own

    def surplus(self, size: int) -> int:
        """How many signatures a set of this size shares with each set that it links with, at least."""
        return max(1, size // SURPLUS)

    def sign(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Signatures of a set; for each if it holds only frequent shingles; and how many it must share to link."""
        rare = ~self.frequent[shingles & np.uint64(2**TABLE_BITS - 1)]
        spread = mix(shingles ^ STEPS[2])
        signs, common = [], []
        smallest_partner = -(-len(shingles) * self.top // self.bottom)
        least = self.surplus(smallest_partner)
        for band, k in self.roles(len(shingles)):
            n = self.partitions(band)
            places = ((shingles >> np.uint64(24)) % np.uint64(n)).astype(np.int64)
            contents = np.zeros(n, dtype=np.uint64)
            np.add.at(contents, places, spread)
            held = np.bincount(places, minlength=n)
            rares = np.bincount(places[rare], minlength=n)
            used = np.flatnonzero(held)
            contents, only_frequent = mix(contents[used]), rares[used] == 0
            size = 2 if 2 ** (band + 1) - 1 <= SHORT_BAND else 1
            surplus = self.surplus(len(shingles)) if size == 1 else size
            if size > 1 or len(used) < k + surplus:
                least = 1  # too few partitions for more to be certain
            order = np.lexsort((contents, only_frequent))[: k + surplus]
            contents, only_frequent = contents[order], only_frequent[order]
            smallest = max(size - max(k + size - len(used), 0), 0)
            for s in range(smallest, size + 1):
                name = mix(np.array([band * 4 + s], dtype=np.uint64))[0]
                if s == 1:
                    signs.append(contents * STEPS[3] + name)
                    common.append(only_frequent)
                else:
                    subsets = np.array(list(combinations(range(len(contents)), s)), dtype=np.int64).reshape(math.comb(len(contents), s), s)
                    signs.append(contents[subsets].sum(axis=1, dtype=np.uint64) * STEPS[3] + name)
                    common.append(only_frequent[subsets].all(axis=1))
        return mix(np.concatenate(signs)), np.concatenate(common), least


def frequent_shingles(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Hashes of shingles that several of a sample of texts hold; at most MOST_FREQUENT."""
    n = docs.count()
    if not n:
        return np.empty(0, np.uint64)
    share = min(1.0, rows / n)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_slices(column(batch, text)):
                found, counts = np.unique(np.concatenate(shingle_sets(data, offsets)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], names=["shingle", "n"])

    sample = docs.filter(F.expr(f"pmod(xxhash64(doc_id, 'shingles'), 1000000) < {round(share * 1e6)}"))
    sums = sample.select(text).mapInArrow(counted, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = sums.filter(F.col("n") >= SAMPLE_LEAST).orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).select("shingle").toPandas()
    return found["shingle"].to_numpy(np.int64).view(np.uint64)


RARE, FREQUENT, DOCUMENT = 0, 1, 2
SIZE_BITS = 36


def signature_rows(docs: DataFrame, signer: Signer, text: str = "text") -> DataFrame:
    """(key, doc, tag): a row per signature and document, and one per document.

    The last two bits of tag are RARE or FREQUENT (key is a signature) or DOCUMENT (key is an equal
    document met before in the task, or the document itself), or DOCUMENT + 1 for a row without
    an id. For documents the next SIZE_BITS bits are the number of shingles, and the rest is how
    many signatures the document must share to have a link.
    """

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("shingles")
        met: dict[bytes, int] = {}
        for batch in batches:
            ids = column(batch, "doc_id").to_pylist()
            for low, high, data, offsets in text_slices(column(batch, text)):
                keys, docs_of, tags = [], [], []
                for doc, shingles in zip(ids[low:high], shingle_sets(data, offsets), strict=True):
                    equal, least = doc, 1
                    if doc is not None and len(shingles):
                        with np.errstate(over="ignore"):
                            print_ = shingles.sum(dtype=np.uint64), mix(shingles).sum(dtype=np.uint64), len(shingles)
                        equal = met.setdefault(b"%d %d %d" % print_, doc)
                        if equal == doc:
                            signs, common, least = signer.sign(shingles)
                            keys.append(signs.view(np.int64))
                            docs_of.append(np.full(len(signs), doc, dtype=np.int64))
                            tags.append(np.where(common, FREQUENT, RARE))
                    keys.append(np.array([equal or 0], dtype=np.int64))
                    docs_of.append(np.array([doc or 0], dtype=np.int64))
                    kind = DOCUMENT if doc is not None else DOCUMENT + 1
                    tags.append(np.array([(least << SIZE_BITS | len(shingles)) << 2 | kind], dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.concatenate(docs_of)), pa.array(np.concatenate(tags).astype(np.int64))],
                    names=["key", "doc", "tag"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(signed, "key long, doc long, tag long")


def sharing_rows(rows: DataFrame) -> DataFrame:
    """(key, doc, tag): the documents that share RARE signatures; the rest stays.

    Of each shared signature, every document gives a row with the smallest id among them as key.
    Rows of one run of signatures are summed up: tag // 4 is how many signatures they stand for.
    """
    place = F.when(F.col("tag") == RARE, F.col("key")).otherwise(F.xxhash64("key", "doc"))
    dealt = rows.repartition(place).sortWithinPartitions("key", "doc")

    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = leader = None
        shared = False  # has the last signature been met with two documents?
        for batch in batches:
            key, doc, tag = (column(batch, c).to_numpy() for c in ("key", "doc", "tag"))
            rare = tag == RARE
            rest = [a[~rare] for a in (key, doc, tag)]
            key, doc = key[rare], doc[rare]
            if len(key):
                begins = np.concatenate([[key[0] != last_key], key[1:] != key[:-1]])
                starts = np.flatnonzero(begins)
                leaders = np.empty(len(key), dtype=np.int64)
                head = starts[0] if len(starts) else len(key)
                if head:
                    leaders[:head] = leader
                if len(starts):
                    leaders[head:] = np.repeat(doc[starts], np.diff(np.append(starts, len(key))))
                others = leaders != doc
                group = np.cumsum(begins)  # 0 is the signature that the batch before ended with
                with_others = np.bincount(group[others], minlength=group[-1] + 1) > 0
                first_of = np.concatenate([[leader or 0], doc[starts]])
                new = with_others.copy()
                new[0] &= not shared
                shared = bool(with_others[-1]) or (group[-1] == 0 and shared)
                last_key, leader = key[-1], leaders[-1]
                pairs = np.stack([np.concatenate([leaders[others], first_of[new]]), np.concatenate([doc[others], first_of[new]])])
                pairs, counts = np.unique(pairs, axis=1, return_counts=True)
                rest = [np.concatenate([a, b]) for a, b in zip(rest, (*pairs, counts * 4 + RARE), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in rest], names=["key", "doc", "tag"])

    return dealt.mapInArrow(led, rows.schema)


def clusters(shared: DataFrame) -> DataFrame:
    """(cluster, doc) of every cluster with two documents or more that share enough signatures to have links."""
    kind = F.col("tag").bitwiseAND(3)
    rare = shared.filter(kind == RARE).select(F.col("key").alias("cluster"), "doc", F.shiftright("tag", 2).alias("n"))
    frequent = shared.filter(kind == FREQUENT).select("key", "doc")
    least = frequent.groupBy("key").agg(F.min("doc").alias("cluster"), F.max("doc").alias("most")).filter(F.col("cluster") < F.col("most"))
    met = frequent.join(least, "key").select("cluster", "doc", F.lit(1).cast("long").alias("n"))
    pairs = written(rare.unionByName(met).groupBy("cluster", "doc").agg(F.sum("n").alias("n")), "sharing_documents")
    needs = shared.filter(kind == DOCUMENT).groupBy("doc").agg(F.min(F.shiftright("tag", SIZE_BITS + 2)).alias("least"))
    # A document has no more clusters than signatures, so these windows are small.
    own = Window.partitionBy("doc")
    upwards = own.orderBy("n", "cluster").rowsBetween(Window.unboundedPreceding, 0)
    counted = pairs.join(needs, "doc").withColumn("total", F.sum("n").over(own)).withColumn("below", F.sum("n").over(upwards))
    # Two linked documents share `least` signatures. If either leaves clusters that stand for less
    # than half as many together, one signature is left whose cluster still holds both.
    members = counted.filter((F.col("total") >= F.col("least")) & (2 * F.col("below") > F.col("least") - 1)).select("cluster", "doc")
    several = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("cluster")
    return members.join(several, "cluster", "left_semi").select("cluster", "doc")


class Forest:
    """Connects positions and remembers which links it took."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def connect(self, i: int, others: np.ndarray) -> None:
        for j in others:
            a, b = self.label[i], self.label[j]
            if a != b:
                self.label[self.label == max(a, b)] = min(a, b)
                self.links.append((i, int(j)))


def linked(sets: list[np.ndarray], side: np.ndarray, threshold: tuple[int, int] = THRESHOLD) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets; with both sides present, of those across."""
    top, bottom = threshold
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    across = bool(side.any() and not side.all())
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if both and bottom * both >= top * (sizes[0] + sizes[1] - both) else []
    items = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(items, kind="stable")
    items, owners = items[order], owners[order]
    begins = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]])) if len(items) else np.empty(0, np.int64)
    ends = np.append(begins[1:], len(items))
    place = np.empty(len(items), dtype=np.int64)
    place[order] = np.repeat(np.arange(len(begins)), ends - begins)  # posting of each item, in the order of the sets
    edges = np.concatenate([[0], np.cumsum(sizes)])
    counts = ends - begins
    forest = Forest(len(sets))
    for i in range(len(sets)):
        if (forest.label == forest.label[0]).all():
            break
        if across and side[i]:
            continue
        postings = place[edges[i] : edges[i + 1]]
        postings = postings[counts[postings] > 1]
        if not len(postings):
            continue
        n = counts[postings]
        at = np.repeat(begins[postings] - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(owners[at], minlength=len(sets))
        near = bottom * both >= top * (sizes + sizes[i] - both)
        near &= (both > 0) & (forest.label != forest.label[i])
        if across:
            near &= side
        forest.connect(i, np.flatnonzero(near))
    return forest.links


def links(members: DataFrame, docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, text: str = "text", block: int = BLOCK) -> DataFrame:
    """(one, other): spanning forests of the exact links within every cluster."""
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    dealt = members.join(sizes, "cluster").withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn(
        "own", F.expr("cast(pmod(xxhash64(doc), blocks) as int)")
    )
    # Block i meets each block j from i on: as the lower one, or as the upper one of an earlier block.
    # The members of a large cluster are multiplied here, so they are dealt over all tasks before.
    met = dealt.repartition("cluster", "doc").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cluster", "doc", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") > F.col("other")).alias("side")
    )
    n_bytes = 48 * met.count()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(met) if n_bytes <= BROADCAST_BYTES else met, "doc")
    rows = rows.repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high", "doc")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def close() -> list[tuple[int, int]]:
            ids = [h[0] for h in held]
            found = linked([h[1] for h in held], np.array([h[2] for h in held], dtype=bool), threshold) if len(held) > 1 else []
            return [(ids[i], ids[j]) for i, j in found if ids[i] != ids[j]]

        last = None
        for batch in batches:
            out = []
            names = list(zip(*(column(batch, c).to_pylist() for c in ("cluster", "low", "high")), strict=True))
            ids, sides = column(batch, "doc").to_pylist(), column(batch, "side").to_pylist()
            for low, high, data, offsets in text_slices(column(batch, "text")):
                for i, shingles in zip(range(low, high), shingle_sets(data, offsets), strict=True):
                    if names[i] != last:
                        out += close()
                        held, last = [], names[i]
                    if len(shingles):
                        held.append((ids[i], shingles, sides[i]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["one", "other"])
        if out := close():
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["one", "other"])

    return rows.mapInArrow(compared, "one long, other long").distinct()


def link_counts(sets: list[np.ndarray], side: np.ndarray, weights: np.ndarray, earlier: list[np.ndarray], threshold: tuple[int, int] = THRESHOLD) -> tuple[list[tuple[int, int]], np.ndarray]:
    """A spanning forest of the links, and for each set the weights of all that it links with.

    With both sides present only links across count, as in `linked`. `earlier` has the clusters in
    which each set has been met before; pairs that have been met there are left out of the sums.
    """
    top, bottom = threshold
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    across = bool(side.any() and not side.all())
    items, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(items, kind="stable")
    _, posting, counts = np.unique(items, return_inverse=True, return_counts=True)
    begins, owners = np.cumsum(counts) - counts, owners[order]
    edges = np.concatenate([[0], np.cumsum(sizes)])
    met: dict[int, list[int]] = {}
    for i, some in enumerate(earlier):
        for c in some.tolist():
            met.setdefault(c, []).append(i)
    known = {c: np.array(some) for c, some in met.items() if len(some) > 1}
    forest, sums = Forest(len(sets)), np.zeros(len(sets), dtype=np.int64)
    for i in range(len(sets)):
        if across and side[i]:
            continue
        own = posting[edges[i] : edges[i + 1]]
        own = own[counts[own] > 1]
        if not len(own):
            continue
        n = counts[own]
        at = np.repeat(begins[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(owners[at], minlength=len(sets))
        near = (both > 0) & (bottom * both >= top * (sizes + sizes[i] - both))
        near[i] = False
        if across:
            near &= side
        forest.connect(i, np.flatnonzero(near & (forest.label != forest.label[i])))
        for c in earlier[i].tolist():
            if c in known:
                near[known[c]] = False
        sums[i] += weights[near].sum()
        if across:
            sums[near] += weights[i]
    return forest.links, sums


def counted_links(members: DataFrame, weights: DataFrame, docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, text: str = "text", block: int = BLOCK) -> DataFrame:
    """(one, other, n): spanning forests as in `links`, and rows without `other` that sum up to the links of `one`.

    Ids are unique; `weights` (doc, weight) says for how many rows each document stands.
    """
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    # A document has no more clusters than signatures.
    own = members.groupBy("doc").agg(F.collect_set("cluster").alias("clusters")).join(weights, "doc")
    dealt = members.join(sizes, "cluster").join(own, "doc").withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn(
        "own", F.expr("cast(pmod(xxhash64(doc), blocks) as int)")
    )
    met = written(dealt.repartition("cluster", "doc").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cluster", "doc", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") > F.col("other")).alias("side"),
        "weight", F.filter("clusters", lambda c: c < F.col("cluster")).alias("earlier"),
    ), "cluster_members")
    n_bytes = met.agg(F.sum(72 + 8 * F.size("earlier"))).first()[0] or 0
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(met) if n_bytes <= BROADCAST_BYTES else met, "doc")
    rows = rows.repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high", "doc")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None

        def close() -> list[tuple[int, int | None, int]]:
            side = np.array([h[2] for h in held], dtype=bool)
            # Two blocks of which one is empty have no pairs of their own.
            if len(held) < 2 or last[1] != last[2] and (side.all() or not side.any()):
                return []
            forest, sums = link_counts([h[1] for h in held], side, np.array([h[3] for h in held]), [h[4] for h in held], threshold)
            return [(held[i][0], held[j][0], 0) for i, j in forest] + [(held[i][0], None, int(sums[i])) for i in np.flatnonzero(sums)]

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["one", "other", "n"])

        for batch in batches:
            out = []
            names = list(zip(*(column(batch, c).to_pylist() for c in ("cluster", "low", "high")), strict=True))
            ids, sides, weight, earlier = (column(batch, c).to_pylist() for c in ("doc", "side", "weight", "earlier"))
            for low, high, data, offsets in text_slices(column(batch, "text")):
                for i, shingles in zip(range(low, high), shingle_sets(data, offsets), strict=True):
                    if names[i] != last:
                        out += close()
                        held, last = [], names[i]
                    if len(shingles):
                        held.append((ids[i], shingles, sides[i], weight[i], np.array(earlier[i], dtype=np.int64)))
            if out:
                yield batch_of(out)
        if out := close():
            yield batch_of(out)

    return rows.mapInArrow(compared, "one long, other long, n long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node reaches, for nodes that are not it.

    Alternates large-star and small-star steps until nothing changes. Each step is a minimum with
    partial minima and a join, so a node with very many edges does not sit in one task.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    pairs = edges.select(F.greatest("one", "other").alias("a"), F.least("one", "other").alias("b")).filter(F.col("a") != F.col("b")).distinct()
    pairs = written(pairs, "edges")
    before = state(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large_star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = written(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "small_star")
        after = state(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))


def similar_documents(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    signer = Signer(threshold, frequent_shingles(docs, text))
    shared = written(sharing_rows(signature_rows(docs, signer, text)), "shared_signatures")
    members = written(clusters(shared), "clusters")
    found = links(members, docs, threshold, text)
    kind = F.col("tag").bitwiseAND(3)
    rows = shared.filter(kind >= DOCUMENT)
    copies = rows.filter((kind == DOCUMENT) & (F.col("key") != F.col("doc"))).select(F.col("key").alias("one"), F.col("doc").alias("other"))
    labels = components(found.unionByName(copies))
    known = kind == DOCUMENT
    return rows.join(labels, known & (F.col("doc") == F.col("node")), "left").select(
        F.when(known, F.col("doc")).alias("doc_id"), F.shiftright("tag", 2).bitwiseAND(2**SIZE_BITS - 1).alias("n_shingles"),
        F.when(known, F.coalesce("component", "doc")).alias("component_id"),
    )


def linked_documents(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    if docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1").isEmpty():
        return _with_links(docs, threshold)
    # Rows of one id are told apart for their links; components are those of ids.
    numbered = written(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "numbered_documents")
    counted = _with_links(numbered.select(F.when(F.col("doc_id").isNotNull(), F.col("row")).alias("doc_id"), "text"), threshold)
    labels = similar_documents(numbered, threshold).filter(F.col("doc_id").isNotNull()).select("doc_id", "component_id").distinct()
    ids = numbered.filter(F.col("doc_id").isNotNull()).select("row", "doc_id").join(labels, "doc_id")
    counted = counted.select(F.col("doc_id").alias("row"), "n_shingles", "n_links")
    return counted.join(ids, "row", "left").select("doc_id", "n_shingles", "component_id", "n_links")


def _with_links(docs: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """`linked_documents` for unique ids."""
    signer = Signer(threshold, frequent_shingles(docs))
    shared = written(sharing_rows(signature_rows(docs, signer)), "shared_signatures")
    members = written(clusters(shared), "clusters")
    kind = F.col("tag").bitwiseAND(3)
    rows = shared.filter(kind >= DOCUMENT)
    weights = rows.filter(kind == DOCUMENT).groupBy(F.col("key").alias("doc")).agg(F.count(F.lit(1)).alias("weight"))
    found = written(counted_links(members, weights, docs, threshold), "links")
    copies = rows.filter((kind == DOCUMENT) & (F.col("key") != F.col("doc"))).select(F.col("key").alias("one"), F.col("doc").alias("other"))
    labels = components(found.filter(F.col("other").isNotNull()).select("one", "other").unionByName(copies))
    sums = found.filter(F.col("other").isNull()).groupBy(F.col("one").alias("doc")).agg(F.sum("n").alias("n"))
    # One row per document that others are copies of, and its number of links.
    heads = weights.join(sums, "doc", "left").select(F.col("doc").alias("head"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    known = kind == DOCUMENT
    linked_rows = rows.join(heads.filter("n_links > 0"), known & (F.col("key") == F.col("head")), "left")
    return linked_rows.join(labels, known & (F.col("doc") == F.col("node")), "left").select(
        F.when(known, F.col("doc")).alias("doc_id"), F.shiftright("tag", 2).bitwiseAND(2**SIZE_BITS - 1).alias("n_shingles"),
        F.when(known, F.coalesce("component", "doc")).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
