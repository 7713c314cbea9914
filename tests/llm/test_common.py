import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from stratalake.llm import common
from stratalake.llm.common import claim, run_hashes, runs, text_runs, text_slices, words

text = st.text(st.sampled_from("aAbZ .\n\t\r\x0b\x1cé💩"), max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | text, min_size=1, max_size=8), st.integers(1, 40))
def test_words_of_every_text(texts, most):
    """Equal words have equal hashes, whatever text or slice they come from, and other words other ones."""
    known, back, seen = {}, {}, 0
    for low, high, data, offsets in text_slices(pa.array(texts, pa.string()), most):
        hashes, first, starts = words(data, offsets)
        for i in range(low, high):
            own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), texts[i] or ""))
            found = hashes[first[i - low] : first[i - low + 1]].tolist()
            assert len(found) == len(own)
            for w, h in zip(own, found, strict=True):
                assert known.setdefault(w, h) == h and back.setdefault(h, w) == w
        seen += high - low
    assert seen == len(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n"), max_size=12), min_size=1, max_size=5))
def test_runs_with_a_byte_that_stands_alone(texts):
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    starts, stops = runs(data, offsets, np.arange(256) == 32, 10)
    found = [data[a : b + 1].tobytes().decode() for a, b in zip(starts, stops, strict=True)]
    assert found == [p for t in texts for p in re.findall(r"\n|[^ \n]+", t)]
    assert len(set(run_hashes(data, starts, stops).tolist())) == len(set(found))


def test_text_runs_cover_a_batch():
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(["x" * (i % 7) if i % 5 else None for i in range(50)])], names=["id", "text"])
    parts = list(text_runs(batch.slice(3, 40), "text", 20))
    assert [i for p, _ in parts for i in p.column(0).to_pylist()] == list(range(3, 43))
    assert all(p.column(1).to_pylist() == t and len(t) == p.num_rows for p, t in parts)
    assert max(sum(len(x or "") for x in t) for _, t in parts) <= 20
    assert list(text_runs(batch.slice(0, 0), "text")) == []


def test_a_worker_keeps_one_owners_tables(monkeypatch):
    monkeypatch.setattr(common, "_KEPT", {})
    dropped = []
    claim("a", lambda: dropped.append("a"))
    claim("a", lambda: dropped.append("a"))
    assert dropped == []
    claim("b", lambda: dropped.append("b"))
    claim("c")
    claim("c")
    assert dropped == ["a", "b"]


def test_hashes_of_long_words():
    rng = np.random.default_rng(1)
    turns = np.array([i.bit_count() % 2 for i in range(2048)])
    texts = ["".join("ab"[t ^ flip] for t in turns[:n]) for n in (7, 8, 9, 16, 17, 511, 512, 513, 1024, 2048) for flip in (0, 1)]
    texts += ["".join(rng.choice(list("ab"), n)) for n in (24, 100, 600)] + ["a" * n for n in range(1, 40)]
    raw = " ".join(texts).encode()
    data = np.frombuffer(raw, np.uint8)
    hashes, _, starts = words(data, np.array([0, len(raw)]))
    assert len(starts) == len(texts) and len(set(hashes.tolist())) == len(set(texts))
    again = [words(np.frombuffer(t.upper().encode(), np.uint8), np.array([0, len(t)]))[0][0] for t in texts]
    assert again == hashes.tolist()
