"""Packing of token sequences by a grouping genetic algorithm on islands.

Documents longer than a sequence are cut into full sequences and a shorter first piece. Full
pieces are sequences by themselves. All other pieces are dealt by hash into regions of about
`REGION_PIECES`; each region is packed by several islands, each with a population of its own.
An individual is a grouping of the region's pieces into bins. Crossover injects the well-filled
bins of one parent whole into the other, dissolves the bins that held a piece twice, and puts
what is displaced back by best fit. After each epoch every island's elite moves to the next
island of the ring, by a join on the small table of islands.

Memory and work of a task are bounded by the region's size, whatever the corpus; the regions'
loss against one joint packing is below one sequence each. Random choices are seeded by region,
island and epoch, so a repeated task gives the same result.

Defined results: a null text counts as empty and is a piece with the end id alone; repeated rows
are packed one by one; an empty table gives no rows; further columns are not carried.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import column, written
from stratalake.llm.tokens import END_ID, crc32, encoder

SEQUENCE = 1024
REGION_PIECES = 16384
ISLANDS = 2
POPULATION = 4
EPOCHS = 3
GENERATIONS = 4
WELL_FILLED = 0.995

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
STATE = "region long, island int, uids binary, lengths binary, people array<binary>"


def cut_lengths(n_tokens: int, most: int = SEQUENCE) -> list[int]:
    """Lengths of a document's pieces: all full but the first."""
    first = n_tokens % most
    return [first] * (first > 0) + [most] * (n_tokens // most)


def token_pieces(docs: DataFrame, tokenizer_path: str, most: int = SEQUENCE, text: str = "text") -> DataFrame:
    """Pieces of all documents with their lengths and checksums, written once."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path).encode, END_ID.to_bytes(4, "little")
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                ids = encode([t or "" for t in column(part, text).to_pylist()])
                rows = []
                for doc_id, raw in zip(column(part, "doc_id").to_pylist(), ids, strict=True):
                    raw += end
                    at = 0
                    for k, n in enumerate(cut_lengths(len(raw) // 4, most)):
                        rows.append((uid, doc_id, k, at, n, crc32(raw[4 * at : 4 * (at + n)])))
                        at += n
                        uid += 1
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ("uid", "doc_id", "piece", "start", "length", "ids_crc32")
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return written(docs.select("doc_id", text).mapInArrow(pieces, PIECES), "pieces")


class Grouping:
    """Bins of pieces; a bin is a tuple of positions in `lengths`, which groupings can share."""

    def __init__(self, lengths: list[int], most: int):
        self.lengths, self.most = lengths, most
        self.bins: list[tuple[int, ...]] = []
        self.room: list[int] = []
        self.scored: tuple[int, int] | None = None

    def copy_bins(self, bins: list[tuple[int, ...]], room: list[int] | None = None) -> None:
        self.bins += bins
        self.room += [self.most - sum(map(self.lengths.__getitem__, b)) for b in bins] if room is None else room

    def best_fit(self, items: list[int]) -> None:
        """Puts each item into the bin that it fills best, or into a new one."""
        by_room: dict[int, list[int]] = {}
        open_rooms = 0  # bit r is set if some bin has room r
        for k, r in enumerate(self.room):
            if r:
                by_room.setdefault(r, []).append(k)
                open_rooms |= 1 << r
        for i in items:
            n = self.lengths[i]
            fits = open_rooms >> n
            if fits:
                r = n + (fits & -fits).bit_length() - 1
                same = by_room[r]
                k = same.pop()
                if not same:
                    open_rooms ^= 1 << r
                self.bins[k] += (i,)
            else:
                r, k = self.most, len(self.bins)
                self.bins.append((i,))
                self.room.append(r)
            self.room[k] = r = r - n
            if r:
                by_room.setdefault(r, []).append(k)
                open_rooms |= 1 << r

    def score(self) -> tuple[int, int]:
        """Fewer bins first, then the more unevenly filled ones, which leave larger rests."""
        if self.scored is None:
            self.scored = len(self.bins), -sum((self.most - r) ** 2 for r in self.room)
        return self.scored

    def encoded(self) -> bytes:
        out = np.zeros(len(self.lengths), dtype="<i4")
        out[[i for b in self.bins for i in b]] = np.repeat(np.arange(len(self.bins)), [len(b) for b in self.bins])
        return out.tobytes()

    @classmethod
    def decoded(cls, raw: bytes, lengths: list[int], most: int) -> Grouping:
        own = cls(lengths, most)
        bins: list[list[int]] = [[] for _ in range(int(np.frombuffer(raw, "<i4").max()) + 1)]
        for i, k in enumerate(np.frombuffer(raw, "<i4").tolist()):
            bins[k].append(i)
        own.copy_bins([tuple(b) for b in bins])
        return own


def fresh(lengths: list[int], most: int, rng: random.Random, noise: float) -> Grouping:
    """Best fit of the pieces from long to short, where `noise` blurs the order."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i] * (1 + noise * rng.random()))
    own = Grouping(lengths, most)
    own.best_fit(order)
    return own


def crossed(one: Grouping, other: Grouping, rng: random.Random) -> Grouping:
    """`one` with well-filled bins of `other` injected whole."""
    least = WELL_FILLED * one.most
    good = [b for b, r in zip(other.bins, other.room, strict=True) if other.most - r >= least]
    if not good:
        good = sorted(other.bins, key=lambda b: -sum(map(other.lengths.__getitem__, b)))[:1]
    low = rng.randrange(len(good))
    injected = (good + good)[low : low + max(1, len(good) // 2)]
    taken = {i for b in injected for i in b}
    child = Grouping(one.lengths, one.most)
    child.copy_bins(injected)
    kept, room, displaced = [], [], []
    for b, r in zip(one.bins, one.room, strict=True):
        if taken.isdisjoint(b):
            # Badly filled bins are dissolved too, now and then, so that their pieces can move.
            if r > one.most - least and rng.random() < 0.3:
                displaced += b
            else:
                kept.append(b)
                room.append(r)
        else:
            displaced += [i for i in b if i not in taken]
    child.copy_bins(kept, room)
    child.best_fit(sorted(displaced, key=lambda i: -one.lengths[i]))
    return child


def evolved(people: list[Grouping], guests: list[Grouping], rng: random.Random, generations: int) -> list[Grouping]:
    """The next population, best first; its size stays."""
    size = len(people)
    pool = sorted(people + guests, key=Grouping.score)
    floor = -(-sum(pool[0].lengths) // pool[0].most)
    for _ in range(generations):
        if len(pool[0].bins) <= floor:
            break  # no packing has fewer
        children = []
        for one in pool[:size]:
            other = rng.choice(pool)
            children.append(crossed(one, other if other is not one else pool[0], rng))
        pool = sorted(pool + children, key=Grouping.score)[:size]
    return pool[:size]


def _bin_rows(pool: list[Grouping]) -> list[bytes]:
    return [g.encoded() for g in pool]


def pack_pieces(pieces: DataFrame, most: int = SEQUENCE, region_pieces: int = REGION_PIECES, islands: int = ISLANDS,
                population: int = POPULATION, epochs: int = EPOCHS, generations: int = GENERATIONS) -> DataFrame:
    """(uid, sequence_id, offset) of all pieces shorter than a sequence."""
    import pandas as pd

    short = pieces.filter(F.col("length") < most).select("uid", F.col("length").cast("int").alias("length"))
    n = short.count()
    regions = max(1, round(n / region_pieces))
    dealt = short.withColumn("region", F.expr(f"pmod(xxhash64(uid), {regions})")).withColumn(
        "island", F.explode(F.array(*[F.lit(i) for i in range(islands)]))
    )

    def begin(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        region, island = int(key[0]), int(key[1])
        items = items.sort_values(["length", "uid"], ascending=[False, True])
        lengths = items["length"].tolist()
        rng = random.Random(f"{region} {island}")
        pool = [fresh(lengths, most, rng, 0.0 if k + island == 0 else 0.05 * (k + island)) for k in range(population)]
        pool = evolved(pool, [], rng, generations)
        return pd.DataFrame({
            "region": [region], "island": [island], "uids": [items["uid"].to_numpy("<i8").tobytes()],
            "lengths": [np.array(lengths, "<i4").tobytes()], "people": [_bin_rows(pool)],
        })

    def proceed(epoch: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                people = []
                for row in frame.itertuples():
                    lengths = np.frombuffer(row.lengths, "<i4").tolist()
                    own = [Grouping.decoded(p, lengths, most) for p in row.people]
                    guest = [Grouping.decoded(row.guest, lengths, most)]
                    people.append(_bin_rows(evolved(own, guest, random.Random(f"{row.region} {row.island} {epoch}"), generations)))
                yield frame.drop(columns="guest").assign(people=people)

        return run

    state = written(dealt.groupBy("region", "island").applyInPandas(begin, STATE), "islands")
    for epoch in range(1, epochs):
        elites = state.select("region", ((F.col("island") + 1) % islands).alias("island"), F.col("people")[0].alias("guest"))
        state = written(state.join(elites, ["region", "island"]).mapInPandas(proceed(epoch), STATE), "islands")

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                lengths = np.frombuffer(row.lengths, "<i4").tolist()
                uids = np.frombuffer(row.uids, "<i8")
                best = min((Grouping.decoded(p, lengths, most) for p in row.elites), key=Grouping.score)
                order = np.array([i for b in best.bins for i in b], dtype=np.int64)
                bins = np.repeat(np.arange(len(best.bins)), [len(b) for b in best.bins])
                sizes = np.array(lengths, dtype=np.int64)[order]
                ends = np.cumsum(sizes)
                first = np.searchsorted(bins, np.arange(len(best.bins)))
                base = (ends - sizes)[first]
                yield pd.DataFrame({"uid": uids[order], "sequence_id": (row.region << 32) + bins, "offset": ends - sizes - base[bins]})

    best = state.groupBy("region").agg(
        F.first("uids").alias("uids"), F.first("lengths").alias("lengths"), F.collect_list(F.col("people")[0]).alias("elites")
    )
    return best.mapInPandas(placed, "uid long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer_path: str, most: int = SEQUENCE, text: str = "text", **search) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = token_pieces(docs, tokenizer_path, most, text)
    places = pack_pieces(pieces, most, **search)
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    whole = pieces.filter(F.col("length") == most).select(
        *columns, (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return whole.unionByName(pieces.filter(F.col("length") < most).join(places, "uid").select(*columns, "sequence_id", "offset"))
