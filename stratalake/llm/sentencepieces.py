"""SentencePiece encoding and decoding by a Viterbi pass over a trie of the distinct marked words.

A text is marked (`▁` for each space, one more in front) and cut into words at the marks; no piece
of the vocabulary holds a mark behind another sign, so no piece reaches across a cut. The distinct
new words of a run of texts are sorted, which is their trie in depth-first order: going from a
word to the next, the forward entries of their common prefix stay and only the rest is computed.

An entry tells how the best path to that prefix ends:
- `unigram`: by the piece with the highest sum of scores on the way to it.
- `bpe`: by the only piece that is stable behind the entry it follows. A merge-based encoding is
  the one path whose neighbouring pieces all stay apart when merged by rank, so a path can be
  extended piece by piece as in Viterbi's pass, with feasibility in the place of a score.
Words with several marks in front have merges of equal rank and are left to the library.

Words and their ids stay in a cache of bounded size; work and memory of a task follow its texts.

Defined results: null and empty texts have no ids and decode to an empty text; characters outside
the vocabulary become byte pieces; repeated rows are encoded one by one; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import claim, text_runs
from stratalake.llm.tokens import crc32

MARK = "▁"
MOST_CACHED = 1_000_000
MOST_PAIRS = 1_000_000
RUN, RUN_BYTES = 1024, 4 * 1024**2
RUNS = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")


class Vocabulary:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        sp = self.processor
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.scores = [sp.get_score(i) for i in range(n)]
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special and not sp.is_byte(i)}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a mark behind another sign, so words can't be told apart")
        self.raw = [p.replace(MARK, " ").encode() for p in self.pieces]
        for b, i in self.bytes.items():
            self.raw[i] = bytes([b])
        for i in special:
            self.raw[i] = b""


class WordEncoder:
    """Ids of marked words."""

    def __init__(self, ids: dict[str, int], scores: list[float], kind: str = "bpe"):
        self.ids, self.scores, self.kind = ids, scores, kind
        self.pieces = {i: p for p, i in ids.items()}
        # Every end of a piece, with the piece's id if it is a whole one, else -1.
        self.ends = {p[k:]: -1 for p in ids for k in range(len(p))} | ids
        self.pairs: dict[int, bool] = {}
        self.sound: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Merges neighbours by the best score of what they become, the leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.ids.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.scores[k] > best):
                    best, at = self.scores[k], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stable(self, left: int, right: int) -> bool:
        """Do these two pieces stay as they are, side by side?"""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            a, b = self.pieces[left], self.pieces[right]
            known = self.pairs[key] = self.merged(a + b) == [a, b]
        return known

    def whole(self, piece: int) -> bool:
        known = self.sound.get(piece)
        if known is None:
            known = self.sound[piece] = len(self.merged(self.pieces[piece])) == 1
        return known

    def encode_sorted(self, words: list[str]) -> Iterator[list[int]]:
        """Ids of each word; `words` is sorted and all its characters are pieces."""
        scores, known_ends = self.scores, self.ends.get
        pairs, unigram = self.pairs, self.kind == "unigram"
        last: list[int] = [-1]  # the piece that ends the best path to each prefix
        size: list[int] = [0]
        total: list[float] = [0.0]
        before = ""
        for word in words:
            n, common = len(word), 0
            most = min(n, len(before))
            while common < most and word[common] == before[common]:
                common += 1
            del last[common + 1 :], size[common + 1 :], total[common + 1 :]
            for end in range(common + 1, n + 1):
                options = []
                for begin in range(end - 1, -1, -1):
                    piece = known_ends(word[begin:end])
                    if piece is None:
                        break
                    if piece >= 0:
                        options.append((begin, piece))
                found, length, best = -1, 0, -1e300
                if unigram:
                    for begin, piece in options:
                        score = total[begin] + scores[piece]
                        if score > best:
                            found, length, best = piece, end - begin, score
                else:
                    for begin, piece in reversed(options):  # long pieces first
                        if begin:
                            fits = pairs.get(last[begin] << 32 | piece)
                            if fits is None:
                                fits = self.stable(last[begin], piece)
                        else:
                            fits = self.whole(piece)
                        if fits:
                            found, length = piece, end - begin
                            break
                last.append(found)
                size.append(length)
                total.append(best)
            before, path, at = word, [], n
            while at:
                path.append(last[at])
                at -= size[at]
            path.reverse()
            yield path


class TextEncoder:
    def __init__(self, model_path: str, kind: str = "bpe"):
        v = self.vocabulary = Vocabulary(model_path)
        self.words = WordEncoder(v.ids, v.scores, kind)
        self.cache: dict[str, bytes] = {}
        self.known = {c for c in v.ids if len(c) == 1}

    @staticmethod
    def marked_words(text: str) -> list[str]:
        if not text:
            return []
        if "  " in text or "\0" in text or MARK in text or text[0] == " " or "\n " in text:
            return RUNS.findall(MARK + text.replace(" ", MARK))
        return (MARK + text.replace(" ", f"\0{MARK}").replace("\n", "\0\n\0")).split("\0")

    def learn(self, new: set[str]) -> None:
        cache = self.cache
        if len(cache) + len(new) > MOST_CACHED:
            cache.clear()
        cache[""] = b""
        new.discard("")
        plain, known = [], self.known
        for w in new:
            if w.startswith(MARK + MARK):
                # The library sets one mark in front by itself.
                ids = self.vocabulary.processor.encode(w[1:].replace(MARK, " "))
                cache[w] = np.array(ids, dtype="<u4").tobytes()
            elif known.issuperset(w):
                plain.append(w)
            else:
                cache[w] = self.with_bytes(w)
        plain.sort()
        for w, ids in zip(plain, self.words.encode_sorted(plain), strict=True):
            cache[w] = np.array(ids, dtype="<u4").tobytes()

    def with_bytes(self, word: str) -> bytes:
        """A word with characters outside the vocabulary: those are spelled in byte pieces."""
        out, run = [], []
        for c in [*word, None]:
            if c in self.known:
                run.append(c)
                continue
            if run:
                out += next(self.words.encode_sorted(["".join(run)]))
                run = []
            if c is not None:
                out += [self.vocabulary.bytes[b] for b in c.encode()]
        return np.array(out, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for low in range(0, len(texts), RUN):
            some = [self.marked_words(t) for t in texts[low : low + RUN]]
            try:
                out += [b"".join(map(self.cache.__getitem__, c)) for c in some]
            except KeyError:
                wanted = set().union(*some)
                new = wanted.difference(self.cache)
                self.learn(wanted if len(self.cache) + len(new) > MOST_CACHED else new)
                out += [b"".join(map(self.cache.__getitem__, c)) for c in some]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids; the mark in front is taken off."""
        raw = b"".join(map(self.vocabulary.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def text_encoder(model_path: str, kind: str = "bpe") -> TextEncoder:
    if (model_path, kind) not in _ENCODERS:
        _ENCODERS[model_path, kind] = TextEncoder(model_path, kind)
    claim(f"{model_path} {kind}", _ENCODERS[model_path, kind].cache.clear)
    return _ENCODERS[model_path, kind]


def encode(docs: DataFrame, model_path: str, keep: list[str | Column], text: str = "text", kind: str = "bpe") -> DataFrame:
    """The chosen columns of each row with `ids`, the piece ids of its whole text."""
    rows = docs.select(*keep, F.col(text).alias("__text"))
    schema = rows.drop("__text").schema.add("ids", T.ArrayType(T.IntegerType()))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = text_encoder(model_path, kind)
        for batch in batches:
            for part, texts in text_runs(batch, "__text", RUN_BYTES):
                raw = own.encode([t or "" for t in texts])
                ends = np.cumsum([0, *(len(r) // 4 for r in raw)]).astype(np.int32)
                ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(raw))])
                out = [c for c, f in zip(part.columns, part.schema.names, strict=True) if f != "__text"]
                yield pa.RecordBatch.from_arrays([*out, pa.ListArray.from_arrays(pa.array(ends), ids)], names=schema.names)

    return rows.mapInArrow(encoded, schema)


def decode(rows: DataFrame, model_path: str, keep: list[str | Column], ids: str = "ids") -> DataFrame:
    """The chosen columns of each row with `text`, decoded from its ids; null ids give a null text."""
    chosen = rows.select(*keep, F.col(ids).alias("__ids"))
    schema = chosen.drop("__ids").schema.add("text", "string")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = text_encoder(model_path)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                lists = part.column(part.schema.get_field_index("__ids"))
                texts = [None if r is None else own.decode(np.array(r, dtype="<u4").tobytes()) for r in lists.to_pylist()]
                out = [c for c, f in zip(part.columns, part.schema.names, strict=True) if f != "__ids"]
                yield pa.RecordBatch.from_arrays([*out, pa.array(texts, pa.string())], names=schema.names)

    return chosen.mapInArrow(decoded, schema)


def digests(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, decoded_sha256, round_trip): what encoding and decoding again give.

    Encodes and decodes in one pass over the texts, so that ids are not moved to be compared.
    """

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = text_encoder(model_path)
        for batch in batches:
            for part, texts in text_runs(batch, text, RUN_BYTES):
                texts = [t or "" for t in texts]
                ids = own.encode(texts)
                back = [own.decode(r) for r in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("doc_id")).cast(pa.int64()), pa.array([len(r) // 4 for r in ids], pa.int64()),
                     pa.array([crc32(r) for r in ids], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string()),
                     pa.array([a == b for a, b in zip(texts, back, strict=True)], pa.bool_())],
                    names=["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "round_trip"],
                )

    return docs.select("doc_id", text).mapInArrow(both, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean")
