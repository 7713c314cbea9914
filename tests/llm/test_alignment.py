import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratalake.llm import alignment, tokens
from stratalake.llm.alignment import common_ends
from stratalake.llm.queries import REGISTRY
from test_packing import ODD, alike

SF_DIR = "/root/testdata/sf0.001"
A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
MORE = ["a▁b", "▁", "▁▁ x", "<s> </s> <unk> <0x41>", "\n", "\nfirst", "a\n\n b", " two", "  three", "x \n y", "　 wide", "ﬁ ﬁ", "é", "\x00"]


@settings(max_examples=500, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_common_ends(a, b):
    a, b = sorted({*a, 61}), sorted({*b, 61})
    left, right = common_ends(np.array(a), np.array(b))
    want = [(a.index(x), b.index(x)) for x in a if x in b]
    assert list(zip(left.tolist(), right.tolist(), strict=True)) == want


def test_common_ends_of_long_stretches():
    rng = random.Random(1)
    for size in (1, 2, 3, 7, 8, 9, 1000, 5000):
        a, b, at = [], [], 0
        while len(a) < size:
            for _ in range(rng.choice([1, 2, 3, 4, 7, 8, 15, 16, 17, 40])):
                at += rng.randrange(1, 9)
                a.append(at)
                b.append(at)
            a += [at + 1, at + 4]
            b += [at + 2, at + 3, at + 5][: rng.randrange(4)]
            at += 6
        a.append(at)
        b.append(at)
        left, right = common_ends(np.array(a), np.array(b))
        both = sorted(set(a) & set(b))
        assert [a[i] for i in left] == [b[j] for j in right] == both
    none = np.array([], dtype=np.int64)
    assert [x.tolist() for x in common_ends(none, none)] == [[], []]


def plain(texts):
    """The contract's columns by dictionaries and loops."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    processor = sentencepiece.SentencePieceProcessor(model_file=B)
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in printable]
    as_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}
    rows, counts = [], Counter()
    for t in texts:
        whole = (" " + (t or "")).encode()
        a = tokenizer.encode(" " + (t or ""), add_special_tokens=False).ids
        b = processor.encode(t or "")
        a_raw = [bytes(as_byte[c] for c in tokenizer.id_to_token(i)) for i in a]
        b_raw = [bytes([int(processor.id_to_piece(i)[3:5], 16)]) if processor.is_byte(i) else processor.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(a_raw) != whole or b"".join(b_raw) != whole:
            rows.append(((0, 0, 0), [], ""))
            continue
        ends = [np.cumsum([len(x) for x in raw]) for raw in (a_raw, b_raw)]
        shared = np.intersect1d(*ends).tolist()
        places = [{e: i for i, e in enumerate(x.tolist())} for x in ends]
        links = [(a[places[0][e]], b[places[1][e]]) for e in shared]
        groups, edges = [], [0, *shared]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            own = []
            for ids, x in zip((a, b), ends, strict=True):
                p, q = np.searchsorted(x, [low, high], side="right")
                own.append(",".join(map(str, ids[p:q])))
            groups.append("|".join(own))
        counts.update(links)
        rows.append(((len(a), len(b), len(shared)), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(*sizes, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest) for sizes, links, digest in rows]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in REGISTRY["op13_token_alignment"](spark, SF_DIR).collect()}
    assert got == dict(zip([d for d, _ in docs], plain([t for _, t in docs]), strict=True))


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 0])
def test_odd_rows_and_clashing_names(spark, broadcast_pairs):
    texts = [None, "", *ODD, *MORE, "x " + alike(1024)[0], "x " + alike(1024)[1], "again and again", "again and again", "long " * 20_000]
    docs = spark.createDataFrame([(None if i == 9 else i // 2, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, links string, row int")
    got = alignment.alignment_counts(docs.repartition(3), A, B, broadcast_pairs=broadcast_pairs).collect()
    want = [(None if i == 9 else i // 2, *r) for i, r in enumerate(plain(texts))]
    assert sorted((tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in got), key=str) == sorted(want, key=str)
    assert alignment.alignment_counts(docs.limit(0), A, B, broadcast_pairs=broadcast_pairs).collect() == []


def test_groups_of_each_row(spark):
    docs = spark.createDataFrame([(1, "Unbelievable tokenization, isn't it?", 3), (2, None, 4), (3, "a▁b", 5)], "doc_id int, text string, a_ids int")
    out = {r.doc_id: r for r in alignment.align(docs, A, B, ["doc_id", "text", "a_ids"]).collect()}
    assert all(out[k][c] == [] for k in (2, 3) for c in alignment.LISTS)
    r, groups = out[1], []
    for a0, a1, b0, b1 in zip([0, *r.a_ends], r.a_ends, [0, *r.b_ends], r.b_ends):
        groups.append(",".join(map(str, r.a_ids[a0:a1])) + "|" + ",".join(map(str, r.b_ids[b0:b1])))
    assert hashlib.sha256(";".join(groups).encode()).hexdigest() == plain([r.text])[0][-1]


def test_ids_by_pieces_are_the_librarys(spark, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()] + ODD + MORE
    library = sentencepiece.SentencePieceProcessor(model_file=B)
    want = [library.encode(t) for t in texts]
    for most in (tokens.MOST_KEPT, 5000):
        monkeypatch.setattr(tokens, "MOST_KEPT", most)
        own = alignment.MarkedPieces(B)
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts, led=True)] == want
