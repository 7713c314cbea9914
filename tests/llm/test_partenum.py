import random
import re

import numpy as np
import pytest

from stratalake.llm import partenum
from stratalake.llm.partenum import Signer, components, linked, linked_documents, shingle_sets, similar_documents

SCHEMA = "doc_id long, text string, component_id string, key long"


def expected(rows, top=75, bottom=100):
    """Sizes and components by comparing all pairs."""
    sets = {}
    for doc, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        s = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        sets.setdefault(doc, []).append(s)
    label = {d: d for d in sets if d is not None}

    def merge(a, b):
        a, b = label[a], label[b]
        for d, c in label.items():
            if c == max(a, b):
                label[d] = min(a, b)

    docs = sorted(label)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            if any(x and y and bottom * len(x & y) >= top * len(x | y) for x in sets[a] for y in sets[b]):
                merge(a, b)
    return sorted(
        ((d, len(s), label.get(d)) for d, group in sets.items() for s in group), key=lambda r: (r[0] is None, r[0] or 0, r[1])
    )


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(5)


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for _ in range(25):
        texts.append(" ".join(rng.choices(vocabulary, k=rng.randrange(1, 120)) + passage[: rng.choice([0, 30, 60])]))
    for size in (4, 9, 20, 45, 130):
        base = rng.choices(vocabulary, k=size)
        texts += near_copies(rng, base, 12, max(1, size // 12))
    texts += [texts[0]] * 5 + [texts[30]] * 3
    rng.shuffle(texts)
    return list(enumerate(texts, start=100))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(spark, seed):
    rows = corpus(seed)
    assert found(similar_documents(frame(spark, rows))) == expected(rows)


def test_other_threshold(spark):
    rows = corpus(3)
    assert found(similar_documents(frame(spark, rows), (60, 100))) == expected(rows, 60, 100)


def test_odd_rows(spark):
    long = " ".join(f"t{i}" for i in range(20000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "one"), (7, "ONE two three four five six"),
            (8, "one two three four five six"), (None, "one two"), (None, "one two"), (9, long), (10, long + " end"), (5, "other words here"),
            (11, "other words here"), (12, "\x0bone\x0ctwo\r")]
    assert found(similar_documents(frame(spark, rows))) == expected(rows)


def test_empty_table(spark):
    assert found(similar_documents(frame(spark, []))) == []


def test_large_clusters_in_blocks(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(40)]
    rows = list(enumerate(near_copies(rng, base, 60, 4)))
    docs = frame(spark, rows)
    members = spark.createDataFrame([(0, d) for d, _ in rows], "cluster long, doc long")
    for limit in (partenum.BROADCAST_BYTES, 0):
        monkeypatch.setattr(partenum, "BROADCAST_BYTES", limit)
        edges = partenum.links(members, docs, block=7)
        label = {r.node: r.component for r in components(edges).collect()}
        assert [(d, n, label.get(d, d)) for d, n, _ in expected(rows)] == expected(rows)


@pytest.mark.parametrize("threshold", [(75, 100), (1, 2), (9, 10), (1, 1)])
def test_sets_that_link_share_a_signature(threshold):
    rng = np.random.default_rng(4)
    top, bottom = threshold
    frequent = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    signer = Signer(threshold, frequent)
    tried = 0
    for _ in range(1500):
        size = int(2 ** rng.uniform(0, 9))
        pool = np.unique(np.concatenate([rng.choice(frequent, size // 2), rng.integers(0, 2**63, 2 * size, dtype=np.uint64)]))
        one = np.sort(rng.choice(pool, min(size, len(pool)), replace=False))
        drop = int(rng.integers(0, max(1, len(one) // 4) + 1))
        other = np.unique(np.concatenate([rng.permutation(one)[drop:], rng.choice(pool, int(rng.integers(0, drop + 1)))]))
        both = len(np.intersect1d(one, other))
        if both and bottom * both >= top * (len(one) + len(other) - both):
            tried += 1
            (first, _, least), (second, _, most) = signer.sign(one), signer.sign(other)
            shared = len(set(first.tolist()) & set(second.tolist()))
            assert shared >= max(least, most) >= 1, (len(one), len(other), both)
    assert tried > 100


def test_threshold_below_a_half_is_refused():
    with pytest.raises(ValueError):
        Signer((1, 3))


def test_linked_finds_links_across_sides_only():
    sets = [np.arange(a, a + 20, dtype=np.uint64) for a in (0, 1, 2, 100, 101)]
    inner = linked(sets, np.zeros(5, bool))
    assert {frozenset(p) for p in inner} == {frozenset(p) for p in ((0, 1), (0, 2), (3, 4))}
    assert linked(sets, np.array([False, False, True, False, False])) == [(0, 2), (1, 2)]


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(7, j) for j in range(100, 200)] + [(3, 7), (200, 201), (201, 200)]
    label = {r.node: r.component for r in components(spark.createDataFrame(edges, "one long, other long")).collect()}
    assert label == {**{i: 20 for i in range(21, 61)}, **{j: 3 for j in [7, *range(100, 200)]}, 201: 200}


def test_shingles_of_short_texts_differ_from_long_ones():
    data = np.frombuffer(b"a b c d e|a b c d|a b c d e f".replace(b"|", b"\n"), np.uint8)
    five, four, six = shingle_sets(data, np.array([0, 10, 18, len(data)]))
    assert len(five) == 1 and len(four) == 1 and len(six) == 2 and five[0] in six and four[0] not in six


def expected_links(rows):
    """(doc, n_shingles, n_links) of each row by comparing all pairs."""
    sets = []
    for doc, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append((doc, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    out = []
    for i, (d, x) in enumerate(sets):
        n = sum(bool(j != i and d is not None and e is not None and x and y and 100 * len(x & y) >= 75 * len(x | y)) for j, (e, y) in enumerate(sets))
        out.append((d is None, d or 0, len(x), n))
    return sorted(out)


@pytest.mark.parametrize("repeated, block", [(False, 1024), (False, 7), (True, 7)])
def test_every_link_is_counted_once(spark, monkeypatch, repeated, block):
    monkeypatch.setattr(partenum.counted_links, "__defaults__", (*partenum.counted_links.__defaults__[:-1], block))
    rows = corpus(4) + [(None, "no id"), (None, "no id"), (900, None), (901, ""), (902, "no id")]
    if repeated:
        rows += [(100, rows[3][1]), (100, rows[0][1]), (107, rows[9][1] + " end"), (902, "no id")]
    got = linked_documents(frame(spark, rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.n_links) for r in got) == expected_links(rows)
    assert max(r.n_links for r in got) >= 5
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r[1])) == expected(rows)


def test_a_slice_with_fewer_words_than_a_shingle(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "A b  c")], "doc_id long, text string").coalesce(1)
    assert sorted(tuple(r) for r in similar_documents(docs).collect()) == [(1, 1, 1), (2, 1, 1)]


def test_long_words_that_polynomial_hashes_confuse(spark):
    turns = [i.bit_count() % 2 for i in range(2048)]
    rows = [(2 * k + flip, "x " + "".join("ab"[t ^ flip] for t in turns[:n])) for k, n in enumerate((1024, 2048)) for flip in (0, 1)]
    got = similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == [(i, 1, i) for i in range(4)]
