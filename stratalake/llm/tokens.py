"""Token ids of whole texts by the tokenizers library, one encoding per distinct piece.

A text is cut at places where none of the tokenizer's own splits can reach across, so the ids of
the pieces, one after the other, are the ids of the text. Each worker keeps the ids of pieces it
has met (a store of bounded size) and hands only new ones to the library.

Where a text may be cut:
- `byte` (byte-level BPE, a word takes its leading space): before each space between two
  characters that are no white space, and on both sides of each line break between two such.
  Texts with longer or other white space go to the library whole.
- `word` (lower case, white space dropped): at spaces and line breaks.

Pieces cover a run of texts without gaps, so Arrow tells the distinct ones apart by their bytes;
ids of all texts are then gathered from the store by position.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import pairwise, repeat
from struct import pack

import numpy as np
import pyarrow as pa

from stratalake.llm.common import claim

END_ID = 2
MOST_KEPT = 96 * 1024**2  # bytes, as estimated from the pieces and ids that are kept
KEPT_PIECE = 180
CALL_BYTES = 64 * 1024
RUN_CHARS = 1024 * 1024
SPACE, BREAK = 32, 10
WHITE = re.compile(r"\s")

# Letters of ASCII and Latin-1, then signs of ASCII: texts whose splits need no further look.
PLAIN = re.compile(r"( ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)?([!-&(-/:-@\[-`{-~]+)?")


def _byte_signs() -> dict[int, str]:
    """How byte-level vocabularies spell these characters: printable bytes stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spelled = {b: chr(b) for b in printable}
    spelled |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in spelled)}
    return {c: "".join(spelled[b] for b in chr(c).encode()) for c in [*range(0x20, 0x7F), *range(0xC0, 0x100)]}


BYTE_SIGNS = _byte_signs()


def values(column: pa.LargeBinaryArray) -> list[bytes]:
    """The values of a column without nulls or offset; several times as fast as to_pylist."""
    raw = column.buffers()[2].to_pybytes() if column.buffers()[2] else b""
    edges = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1).tolist()
    return [raw[a:b] for a, b in pairwise(edges)]


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers, without special tokens."""

    most_kept: int | None = None  # instead of MOST_KEPT

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.byte_level = not self.tokenizer.normalizer
        self._forget()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        lengths = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            lengths[i] = len(token.removesuffix("</w>"))
        self.lengths = lengths  # bytes of text that each id stands for; a byte is one character in the vocabulary

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}  # a piece's own bytes -> its number
        self.kept = 0
        self.again = np.zeros(1024, dtype=bool)  # met in more than one run of texts
        self.begin = np.zeros(1024, dtype=np.int64)  # where the ids of each piece begin in the store
        self.count = np.zeros(1024, dtype=np.int64)
        self.store = np.zeros(4096, dtype="<u4")
        self.used = 0

    def _keep(self, keys: list[bytes], flat: np.ndarray, sizes: np.ndarray) -> None:
        low, high = len(self.place), len(self.place) + len(keys)
        while high > len(self.begin):
            self.begin, self.count = np.concatenate([self.begin, self.begin]), np.concatenate([self.count, self.count])
            self.again = np.concatenate([self.again, np.zeros_like(self.again)])
        while self.used + len(flat) > len(self.store):
            self.store = np.concatenate([self.store, self.store])
        self.count[low:high] = sizes
        self.begin[low:high] = self.used + np.cumsum(sizes) - sizes
        self.store[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.place.update(zip(keys, range(low, high), strict=True))
        self.kept += KEPT_PIECE * len(keys) + sum(map(len, keys)) + 4 * len(flat)

    def _drop_rare(self) -> None:
        """Keeps the pieces that were met again, or none if they fill most of the store by themselves."""
        which = np.flatnonzero(self.again[: len(self.place)])
        names, sizes = list(self.place), self.count[which]
        often = [names[i] for i in which.tolist()]
        ends = np.cumsum(sizes)
        flat = self.store[np.repeat(self.begin[which] - ends + sizes, sizes) + np.arange(sizes.sum())]
        self._forget()
        if 4 * len(flat) + sum(map(len, often)) + KEPT_PIECE * len(often) <= 0.7 * (self.most_kept or MOST_KEPT):
            self._keep(often, flat, sizes)

    def regular(self, text: str) -> bool:
        """May this text be cut at its spaces and line breaks?"""
        # Cut at single spaces and line breaks it falls into its words: no runs of white space, no other kinds.
        return not self.byte_level or text.split() == text.replace("\n", " ").split(" ")

    def _encoded(self, new: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        cache: dict[str, bytes] = {}
        rest, done, tokenize = [], {}, self.tokenizer.model.tokenize
        for p in new:
            parts = PLAIN.fullmatch(p)
            if not parts or not self.byte_level and p[:1] == " ":
                rest.append(p)
                continue
            ids = b""
            for part in parts.groups():  # letters, then signs: two splits of the tokenizer
                if part:
                    own = done.get(part)
                    if own is None:
                        known = (part if self.byte_level else part.lower()).translate(BYTE_SIGNS)
                        found = [x.id for x in tokenize(known)]
                        own = done[part] = pack(f"<{len(found)}I", *found)
                    ids += own
            cache[p] = ids
        # In a joint text each piece is led by a space, or by a line break of its own, so all
        # cuts are safe. Pieces that hold other white space are encoded on their own.
        joint = [p for p in rest if not WHITE.search(p[1:] if self.byte_level and p[0] == " " else p)]
        alone = list(set(rest).difference(joint)) if len(joint) < len(rest) else []
        at = 0
        while at < len(joint):
            size, low = 0, at
            while at < len(joint) and size < CALL_BYTES:
                size += len(joint[at]) + 1
                at += 1
            some = joint[low:at]
            led = [p if self.byte_level and p[0] == " " else "\n" + p for p in some]
            text = "".join(led)
            if not self.byte_level:
                led = self.tokenizer.normalizer.normalize_str(text).split(" ")[1:]
                if len(led) != len(some):
                    alone += some
                    continue
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
            ends = np.cumsum(self.lengths[ids])
            sizes = [len(p) if p.isascii() else len(p.encode()) for p in led]
            cuts = (np.searchsorted(ends, np.cumsum(sizes)) + 1).tolist()
            raw, last = ids.tobytes(), 0
            for p, cut in zip(some, cuts, strict=True):
                if self.byte_level and p[0] != " ":
                    last += 1  # the line break
                cache[p] = raw[4 * last : 4 * cut]
                last = cut
        cache.update(zip(alone, self._whole(alone), strict=True))
        return [cache[p] for p in new]

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text by the library, in one piece."""
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str], led: bool = False) -> list[bytes]:
        """Ids of each text, or of a space and the text if `led`; an empty text has none either way."""
        lead = " " if led else ""
        out = [b""] * len(texts)
        odd = [i for i, t in enumerate(texts) if t and not self.regular(t)]
        for i, ids in zip(odd, self._whole([lead + texts[i] for i in odd]), strict=True):
            out[i] = ids
        odd = set(odd)
        run, size = [], 0
        for i, t in enumerate(texts):
            if t and i not in odd:
                run.append(i)
                size += len(t)
            if run and (size >= RUN_CHARS or i == len(texts) - 1):
                for k, ids in zip(run, self._encode_run([(lead + texts[k]).encode() for k in run]), strict=True):
                    out[k] = ids
                run, size = [], 0
        return out

    def _places(self, known: list[bytes]) -> np.ndarray:
        """The number of each piece in the store, or -1."""
        return np.fromiter(map(self.place.get, known, repeat(-1)), np.int64, len(known))

    def _encode_run(self, texts: list[bytes]) -> list[bytes]:
        raw = b"".join(texts)
        data = np.frombuffer(raw, dtype=np.uint8)
        offsets = np.cumsum([0, *map(len, texts)])
        begins = data == SPACE
        begins |= data == BREAK
        if self.byte_level:
            begins[1:] |= data[:-1] == BREAK
        begins[offsets[:-1]] = True
        edges = np.append(np.flatnonzero(begins), len(data))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(raw)])
        found = pieces.dictionary_encode()
        which, known = found.indices.to_numpy(), values(found.dictionary)
        place = self._places(known)
        missing = np.flatnonzero(place < 0)
        self.again[place[place >= 0]] = True
        if len(missing):
            if self.kept > (self.most_kept or MOST_KEPT):
                self._drop_rare()
                place = self._places(known)
                missing = np.flatnonzero(place < 0)
            new = [known[i] for i in missing.tolist()]
            plain = [p.decode() for p in new] if self.byte_level else [p.decode().strip(" \n") for p in new]
            ids = self._encoded(plain)
            place[missing] = len(self.place) + np.arange(len(new))
            self._keep(new, np.frombuffer(b"".join(ids), dtype="<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4)
        own = place[which]
        sizes = self.count[own]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.store[np.repeat(self.begin[own] - ends + sizes, sizes) + np.arange(total)].tobytes()
        cuts = np.concatenate([[0], ends])[np.searchsorted(edges, offsets)] * 4
        return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    claim(path, _ENCODERS[path]._forget)
    return _ENCODERS[path]


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids)
