"""Alignment of two tokenizers' tokens by byte offsets, and how often their ids end together in a corpus.

Both tokenizers spell the same bytes, so the tokens of a text are two rising arrays of end
offsets. Offsets in both arrays cut the text into groups. They are found by **diagonal run skipping**:
while the tokens go one to one, ends at the same index shift are equal, so stretches of 1, 2, 4, ... ends are compared
whole, and the last one by halves; where they differ, the side that is behind steps on until
ends meet again, which sets the new shift. Texts of a slice lie one after the other and are aligned in one go, since
the end of a text ends a token on both sides.

The last tokens of a group end together; such a pair is a link. Links of the corpus are counted by pairs
of ids and each text's links then take the counts. The table of pairs has at most one row per pair of vocabulary
entries and in effect far fewer; below `BROADCAST_PAIRS` rows it goes to the executors, and links
stay where they are. Above, links are summed by text and pair and meet it in a sort-merge join, whose hot
pairs adaptive execution splits. Links are written once in between, so texts are not encoded twice.

Memory of a task follows a slice of about 1 MB of text or one longer text, and two stores of pieces of bounded size.

Defined results: a text that is null or empty, or whose tokens spell other bytes than a space and the text (one with a
character `▁`, for instance), has no tokens; strings of special tokens are plain text; repeated rows are
aligned and counted one by one; an empty table gives no rows; other columns don't matter, clashing names are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import claim, column, text_runs, written
from stratalake.llm.tokens import PieceEncoder

MARK = "▁"
BROADCAST_PAIRS = 2_000_000
KEPT_PER_SIDE = 60 * 1024**2  # bytes of pieces and ids that a worker keeps for each tokenizer
LISTS = ("a_ids", "b_ids", "a_ends", "b_ends")


class MarkedPieces(PieceEncoder):
    """Ids by the sentencepiece library, which sets a mark for a space in front of each text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        self.byte_level = True  # pieces are cut at single spaces and line breaks, as for byte-level vocabularies
        self._forget()

    def regular(self, text: str) -> bool:
        return MARK not in text and super().regular(text)

    def _encoded(self, new: list[str]) -> list[bytes]:
        # A piece without a space in front begins behind a line break, which is two ids with its mark and part of no merge.
        found = self.processor.encode([p[1:] if p[0] == " " else p if p == "\n" else "\n" + p for p in new], num_threads=1)
        skipped = (0 if p[0] == " " else 1 if p == "\n" else 2 for p in new)
        return [np.array(ids[k:], dtype="<u4").tobytes() for ids, k in zip(found, skipped, strict=True)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, dtype="<u4").tobytes() for ids in self.processor.encode([t[1:] for t in texts], num_threads=1)]

    def token_bytes(self) -> list[bytes]:
        sp = self.processor
        out = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            out.append(bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace(MARK, " ").encode())
        return out


def byte_level_tokens(encoder: PieceEncoder) -> list[bytes]:
    """The bytes of each entry of a byte-level vocabulary, whose characters stand for bytes."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spelled = {chr(b): b for b in printable}
    spelled |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    out = [b""] * len(encoder.lengths)
    for token, i in encoder.tokenizer.get_vocab(with_added_tokens=True).items():
        out[i] = bytes(spelled[c] for c in token) if all(c in spelled for c in token) else token.encode()
    return out


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices into two rising arrays, which end with the same value, where they hold equal values."""
    left, right = a.tolist(), b.tolist()
    raw_a, raw_b = a.tobytes(), b.tobytes()
    n, m, width = len(left), len(right), a.itemsize
    i = j = 0
    at, shifts, sizes = [], [], []
    while i < n:
        x, y = left[i], right[j]
        while x != y:
            if x < y:
                i += 1
                x = left[i]
            else:
                j += 1
                y = right[j]
        # Ends at this shift: p and q are where the next stretch begins, in bytes. At the end of an array it is shorter.
        p, q, step = width * (i + 1), width * (j + 1), width
        while True:
            some = raw_a[p : p + step]
            if not some or some != raw_b[q : q + step]:
                break
            p += len(some)
            q += len(some)
            step += step
        while step > width:
            step >>= 1
            some = raw_a[p : p + step]
            if some and some == raw_b[q : q + step]:
                p += len(some)
                q += len(some)
        size = p // width - i
        at.append(i)
        shifts.append(j - i)
        sizes.append(size)
        i += size
        j += size
    sizes = np.array(sizes, dtype=np.int64)
    ends = np.cumsum(sizes)
    own = np.repeat(np.array(at, dtype=np.int64) - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
    return own, own + np.repeat(np.array(shifts, dtype=np.int64), sizes)


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = PieceEncoder(a_path), MarkedPieces(b_path)
        self.a.most_kept = self.b.most_kept = KEPT_PER_SIDE
        self.a_bytes, self.b_bytes = byte_level_tokens(self.a), self.b.token_bytes()
        self.a_sizes = np.array(list(map(len, self.a_bytes)), dtype=np.int64)
        self.b_sizes = np.array(list(map(len, self.b_bytes)), dtype=np.int64)
        # How ids are written in a group: before another one of their side, and as the last.
        self.spelled = [f"{i}{end}".encode() for end, some in ((",", self.a_bytes), ("|", self.a_bytes), (",", self.b_bytes), (";", self.b_bytes))
                        for i in range(len(some))]

    def forget(self) -> None:
        self.a._forget()
        self.b._forget()

    def ids(self, encoder: PieceEncoder, known: list[bytes], texts: list[str], raw: list[bytes]) -> list[bytes]:
        """Ids of each text, none if they spell other bytes."""
        found = encoder.encode(texts, led=True)
        flat = np.frombuffer(b"".join(found), "<u4").tolist()
        ends = np.cumsum([0, *(len(x) // 4 for x in found)]).tolist()
        same = (b"".join(map(known.__getitem__, flat[p:q])) == r for p, q, r in zip(ends[:-1], ends[1:], raw, strict=True))
        return [x if s else b"" for x, s in zip(found, same, strict=True)]

    def align(self, texts: list[str | None]) -> Slice:
        """Both sides' tokens of some texts and where they end together."""
        texts = [t or "" for t in texts]
        raw = [b" " + t.encode() if t else b"" for t in texts]
        a = self.ids(self.a, self.a_bytes, texts, raw)
        b = self.ids(self.b, self.b_bytes, texts, raw)
        for i in range(len(texts)):
            if not a[i] or not b[i]:
                a[i] = b[i] = b""
        return Slice(self, a, b)


class Slice:
    """Aligned texts that lie one after the other."""

    def __init__(self, aligner: Aligner, a: list[bytes], b: list[bytes]):
        self.aligner = aligner
        self.a_ids, self.b_ids = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in (a, b))
        self.a_first, self.b_first = (np.cumsum([0, *(len(i) // 4 for i in x)]) for x in (a, b))
        self.a_links, self.b_links = common_ends(np.cumsum(aligner.a_sizes[self.a_ids]), np.cumsum(aligner.b_sizes[self.b_ids]))
        self.first = np.searchsorted(self.a_links, self.a_first)

    def spelled_groups(self) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` for each text."""
        n, m = len(self.a_ids), len(self.b_ids)
        a_last, b_last = np.zeros(n, dtype=np.int64), np.zeros(m, dtype=np.int64)
        a_last[self.a_links] = 1
        b_last[self.b_links] = 1
        # A token stands behind its own side's before it, and behind the other side's of all groups before (of its own group, too, for b).
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        codes = np.empty(n + m, dtype=np.int64)
        entries, others = len(self.aligner.a_bytes), len(self.aligner.b_bytes)
        codes[np.arange(n) + np.concatenate([[0], self.b_links + 1])[a_group]] = self.a_ids + entries * a_last
        codes[np.arange(m) + (self.a_links + 1)[b_group]] = 2 * entries + self.b_ids + others * b_last
        known, first = self.aligner.spelled.__getitem__, (self.a_first + self.b_first).tolist()
        codes = codes.tolist()
        return [b"".join(map(known, codes[p:q]))[:-1] for p, q in zip(first[:-1], first[1:], strict=True)]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    claim(f"{a_path} {b_path}", _ALIGNERS[a_path, b_path].forget)
    return _ALIGNERS[a_path, b_path]


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


def align(docs: DataFrame, a_path: str, b_path: str, keep: list[str | Column], text: str = "text") -> DataFrame:
    """The chosen columns of each row with the ids of both sides and where groups end.

    Group g holds the tokens `a_ends[g - 1]` to `a_ends[g]` of `a_ids`, and likewise for b.
    """
    rows = docs.select(*keep, F.col(text).alias("__text")).drop(*LISTS)
    schema = T.StructType([f for f in rows.schema.fields if f.name != "__text"])
    for name in LISTS:
        schema = schema.add(name, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        for batch in batches:
            for part, texts in text_runs(batch, "__text"):
                s = own.align(texts)
                counts = np.diff(s.first)
                new = [
                    lists(s.a_ids, s.a_first, pa.int32()), lists(s.b_ids, s.b_first, pa.int32()),
                    lists(s.a_links + 1 - np.repeat(s.a_first[:-1], counts), s.first, pa.int32()),
                    lists(s.b_links + 1 - np.repeat(s.b_first[:-1], counts), s.first, pa.int32()),
                ]
                kept = [c for c, n in zip(part.columns, part.schema.names, strict=True) if n != "__text"]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=schema.names)

    return rows.mapInArrow(run, schema)


def summaries(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, groups_sha256, links): counts, digest and linked ids of each row in one pass.

    `row` numbers the rows; a link is the id of a times the entries of b, plus the id of b.
    """
    own = aligner(a_path, b_path)
    entries = len(own.b_bytes)
    kind = pa.int32() if len(own.a_bytes) * entries < 2**31 else pa.int64()
    schema = f"row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<{'int' if kind == pa.int32() else 'bigint'}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = aligner(a_path, b_path), TaskContext.get().partitionId() << 33
        for batch in batches:
            for part, texts in text_runs(batch, "__text"):
                s = own.align(texts)
                groups = [hashlib.sha256(g).hexdigest() if g else "" for g in s.spelled_groups()]
                new = [np.diff(x) for x in (s.a_first, s.b_first, s.first)]
                links = lists(s.a_ids[s.a_links] * entries + s.b_ids[s.b_links], s.first, kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at + np.arange(len(texts))), column(part, "doc_id"), *map(pa.array, new), pa.array(groups, pa.string()), links],
                    names=["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"],
                )
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("__text")).mapInArrow(run, schema)


def pair_counts(links: DataFrame, entries: int) -> DataFrame:
    """(link, n, best): how many links hold each pair of ids, and if no pair with the same b is in more."""
    pairs = links.groupBy("link").agg(F.count(F.lit(1)).alias("n"))
    most = pairs.groupBy((F.col("link") % entries).alias("b_id")).agg(F.max("n").alias("most"))
    return pairs.join(most, F.col("link") % entries == F.col("b_id")).select("link", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment_counts(docs: DataFrame, a_path: str, b_path: str, text: str = "text", broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per row: tokens of both sides, groups, links, and how common the linked pairs of ids are in the whole corpus.

    `n_best` counts links whose pair is the most frequent one of its id of b, ties included;
    `count_sum` adds up the frequencies of the links' pairs; `groups_sha256` digests the groups' ids.
    """
    entries = len(aligner(a_path, b_path).b_bytes)
    rows = written(summaries(docs, a_path, b_path, text), "aligned")
    links = rows.select("row", F.explode("links").alias("link"))
    pairs = written(pair_counts(links, entries), "linked_pairs")
    if pairs.count() <= broadcast_pairs:
        met = links.join(F.broadcast(pairs), "link").withColumn("times", F.lit(1))
    else:
        met = links.groupBy("row", "link").agg(F.count(F.lit(1)).alias("times")).join(pairs, "link")
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    whole = rows.drop("links").join(sums, "row", "left")
    none = F.lit(0).cast("long")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )
