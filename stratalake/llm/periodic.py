"""Runs of words: maximal periodic stretches, found by string synchronising sets.

A run is a stretch of words with smallest period p, at least `exponent` (3 or more) periods and
`least` words long, that no neighbouring word extends. The words of many texts lie one after the
other as numbers, with a word of its own behind each text, so nothing reaches across texts.

For each scale t = 1, 2, 4, ... a word's identifier is a hash of the t words from it on, built
from those of the scale before. Position i is in the synchronising set if the smallest
identifier at i to i + t stands at one of the two ends. Whether it is depends on the words i to
i + 2t only (its context), so equal contexts are chosen alike. Positions that begin t words with a
period of t/3 or less are left out of the comparison: there the set would be dense. These highly
periodic regions belong to runs of smaller periods, which earlier scales have found; periods
of one are found as equal neighbours.

A run of period p between 1.5t and 3t has a position of the set in its first two periods, since
not all of it is highly periodic, and the same context stands p words further on. So the pairs of
positions with equal contexts and a distance in that range propose all such periods. A context that is
not highly periodic comes again after more than t/3 words, so each position has fewer than nine
such partners, and a text has a few proposals per word in the worst case. Proposals whose neighbourhood
is not equal one period on are dropped by hash; the rest is confirmed and extended by comparing words.

Memory of a task follows a slice of texts of about `SLICE_BYTES`, or a single longer text.

Defined results: null and empty texts and texts of white space have no words and no runs; repeated
rows are judged one by one; an empty table gives no rows; a text as long as memory allows is read
whole; other columns don't matter, and clashing names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import GOLDEN, ODD, column, mix, text_slices

LEAST = 24
EXPONENT = 3
PARTNERS = 9
NEVER = np.uint64(2**64 - 1)
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, and where each text's words begin."""
    found = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words, edges = found.flatten(), found.offsets.to_numpy()
    whole = pc.not_equal(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(whole.to_numpy(zero_copy_only=False))])
    return words.filter(whole), kept[edges - edges[0]]


def numbered(words: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal numbers for equal words, with a number of its own behind each text, and where texts begin now."""
    own = words.dictionary_encode()
    texts = len(first) - 1
    ids = np.empty(len(words) + texts, dtype=np.int64)
    marks = first[1:] + np.arange(texts)
    inner = np.ones(len(ids), dtype=bool)
    inner[marks] = False
    ids[inner] = own.indices.to_numpy()
    ids[marks] = len(own.dictionary) + np.arange(texts)
    return ids, first + np.arange(texts + 1)


def stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and length of the maximal stretches of true values that are long enough."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    long = ends - begins >= least
    return begins[long], (ends - begins)[long]


def covered(n: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n positions lie in one of these ranges."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, begins, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:n]) > 0


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbouring values, `width` - 1 fewer than there are."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


class Runs:
    """All runs with an exponent of 3 or more in texts that lie one after the other."""

    def __init__(self, ids: np.ndarray, first: np.ndarray):
        self.ids, self.first = ids, first
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # begin, length, period
        longest = int(np.max(np.diff(first), initial=1)) - 1
        begins, lengths = stretches(ids[1:] == ids[:-1], 2)
        self.add(begins, lengths + 1, 1)
        with np.errstate(over="ignore"):
            names, scale = mix(ids.astype(np.uint64) * GOLDEN + ODD), 1
            # A run of three periods of 1.5 t needs 4.5 t words.
            while 9 * scale <= 2 * longest:
                names = self.at_scale(names, scale)
                scale *= 2

    def add(self, begins: np.ndarray, lengths: np.ndarray, period: int) -> None:
        if len(begins):
            self.found.append((begins, lengths, np.full(len(begins), period, dtype=np.int64)))

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.found:
            return tuple(np.empty(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(part) for part in zip(*self.found, strict=True))

    def at_scale(self, names: np.ndarray, t: int) -> np.ndarray:
        """Adds the runs with periods of 1.5 t to 3 t; the identifiers of the next scale."""
        contexts = mix(mix(names[:-t]) + names[t:] * ODD)
        ranked = names
        begins, lengths, periods = self.all()
        dense = (3 * periods <= t) & (lengths >= t)
        if dense.any():
            ranked = np.where(covered(len(names), begins[dense], (begins + lengths)[dense] - t + 1), NEVER, names)
        low = smallest(ranked, t + 1)
        n = min(len(low), len(contexts))
        low = low[:n]
        chosen = np.flatnonzero(((ranked[:n] == low) | (ranked[t : t + n] == low)) & (low != NEVER))
        self.confirm(*self.proposals(contexts, chosen, t))
        return contexts

    def proposals(self, contexts: np.ndarray, chosen: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and periods: equal contexts at chosen positions, 1.5 t to 3 t apart."""
        low, high = -(-3 * t // 2), 3 * t
        order = chosen[np.argsort(contexts[chosen], kind="stable")]
        own = contexts[order]
        at, periods = [], []
        for k in range(1, PARTNERS + 1):
            apart = order[k:] - order[:-k]
            near = np.flatnonzero((own[k:] == own[:-k]) & (apart >= low) & (apart < high))
            at.append(order[near])
            periods.append(apart[near])
        at, periods = np.concatenate(at), np.concatenate(periods)
        # In three periods, the whole period before or behind a position comes again one period on.
        last = len(contexts) - 1
        more = np.maximum(periods - 2 * t, 0)
        behind = contexts[at + more] == contexts[np.minimum(at + more + periods, last)]
        back = np.maximum(at - periods, 0)
        end = np.maximum(at - 2 * t, back)
        before = (at >= periods) & (contexts[back] == contexts[at]) & (contexts[end] == contexts[end + periods])
        kept = behind | before
        return at[kept], periods[kept]

    def confirm(self, at: np.ndarray, periods: np.ndarray) -> None:
        """Compares words, one text and period after the other, and adds what is a run of that smallest period."""
        if not len(at):
            return
        own = np.searchsorted(self.first, at, side="right") - 1
        order = np.lexsort((at, own, periods))
        at, own, periods = at[order], own[order], periods[order]
        cuts = np.flatnonzero((np.diff(own) != 0) | (np.diff(periods) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
            p, text = int(periods[a]), int(own[a])
            low, high = int(self.first[text]), int(self.first[text + 1])
            words = self.ids[low:high]
            begins, lengths = stretches(words[:-p] == words[p:], 2 * p)
            hit = np.searchsorted(begins, at[a:b] - low, side="right") - 1
            hit = np.unique(hit[hit >= 0])
            fresh = [primitive(words[s : s + p]) for s in begins[hit].tolist()]
            self.add(begins[hit][fresh] + low, lengths[hit][fresh] + p, p)


def primitive(period: np.ndarray) -> bool:
    """Is this no repetition of something shorter? Else its run has a smaller period, which an earlier scale has found."""
    n = rest = len(period)
    d = 2
    while rest > 1:
        if d * d > rest:
            d = rest
        if rest % d == 0:
            step = n // d
            if np.array_equal(period[:-step], period[step:]):
                return False
            while rest % d == 0:
                rest //= d
        d += 1
    return True


def find_runs(ids: np.ndarray, first: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> tuple[np.ndarray, ...]:
    """(text, start within it, length, period) of every run, by text, start and period."""
    begins, lengths, periods = Runs(ids, first).all()
    long = (lengths >= least) & (lengths >= exponent * periods)
    begins, lengths, periods = begins[long], lengths[long], periods[long]
    text = np.searchsorted(first, begins, side="right") - 1
    order = np.lexsort((periods, begins))
    return tuple(x[order] for x in (text, begins - first[text], lengths, periods))


def judged(texts: pa.Array, least: int, exponent: int) -> list[pa.Array]:
    """For each text: its number of words, its runs, and the words that stay, joined by spaces."""
    words, first = words_of(texts)
    ids, marked = numbered(words, first)
    text, starts, lengths, periods = find_runs(ids, marked, least, exponent)
    edges = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
    runs = pa.ListArray.from_arrays(
        pa.array(edges), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (starts, lengths, periods)], names=["start", "length", "period"])
    )
    if len(text):
        begins = first[text] + starts
        stays = ~covered(len(words), begins + periods, begins + lengths)
        words, first = words.filter(pa.array(stays)), np.concatenate([[0], np.cumsum(stays)])[first]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(first, pa.int32()), words), pa.scalar(" ", pa.large_string()))
    return [pa.array(np.diff(marked) - 1, pa.int64()), runs, collapsed.cast(pa.string())]


def collapse(docs: DataFrame, keep: list[str | Column], text: str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """The chosen columns of each row with `n_words`, `runs` and `collapsed`, its text without repetition.

    `runs` holds start, length and period in words. Of each run only the first period stays.
    """
    if exponent < EXPONENT:
        raise ValueError(f"the exponent must be {EXPONENT} or more")
    names = ["n_words", "runs", "collapsed"]
    rows = docs.select(*keep, F.col(text).alias("__text"))
    rows = rows.drop(*names)
    schema = T.StructType([f for f in rows.schema.fields if f.name != "__text"])
    schema = schema.add("n_words", "long").add("runs", T.ArrayType(RUN)).add("collapsed", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != "__text"]
            texts = column(batch, "__text")
            for low, high, _, _ in text_slices(texts):
                new = judged(texts.slice(low, high - low), least, exponent)
                yield pa.RecordBatch.from_arrays([*(c.slice(low, high - low) for c in kept), *new], names=schema.names)

    return rows.mapInArrow(run, schema)


def digests(found: DataFrame, keep: list[str | Column]) -> DataFrame:
    """The chosen columns with the number of runs, the run of greatest exponent, and digests of runs and collapsed text."""
    # Exponents are compared as fractions: a / b < c / d if a * d < c * b. Runs come by start, then period.
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
        lambda top, r: F.when(r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top),
    )
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    rows = found.withColumn("__best", best)
    return rows.select(
        *keep, F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"__best.{n}").alias(n) for n in ("start", "length", "period")],
        F.floor(F.col("__best.length") * 1000 / F.col("__best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
