import functools
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stratalake.llm import packing, tokens
from stratalake.llm.packing import Grouping, crossed, cut_lengths, evolved, fresh, pack
from stratalake.llm.tokens import PieceEncoder, crc32

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, piece string, offset string"


@functools.cache
def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def reference(text, path=PATH):
    return np.array(library(path).encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")


def check(rows, got, most):
    ids = defaultdict(list)
    for d, t in rows:
        ids[d].append(reference(t))
    want = sorted(
        (d or -1, k, at, n, crc32(x[at : at + n].tobytes()))
        for d, group in ids.items() for x in group
        for k, (at, n) in enumerate(zip(np.cumsum([0, *cut_lengths(len(x), most)]).tolist(), cut_lengths(len(x), most)))
    )
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    total = sum(r.length for r in got)
    return len(held), -(-total // most)


@pytest.mark.parametrize("regions", [60, 16384])
def test_every_piece_has_its_place(spark, regions):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["alpha", "beta,", "gamma.\n", "Ünï", "12"]) for _ in range(rng.randrange(120)))) for i in range(250)]
    rows += [(3, "again"), (3, "again"), (None, "no id"), (900, None), (901, ""), (902, "word " * 5000), (903, "<|endoftext|> a  b \t c\r\n")]
    docs = spark.createDataFrame([(d, t, "p", "o") for d, t in rows], SCHEMA).repartition(4)
    n, floor = check(rows, pack(docs, PATH, 64, region_pieces=regions).collect(), 64)
    assert n <= floor * 1.1 + len(rows) / regions


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_cut_lengths():
    assert [cut_lengths(n, 4) for n in (1, 4, 5, 8, 11)] == [[1], [4], [1, 4], [4, 4], [3, 4, 4]]


def test_genetic_steps_keep_all_pieces():
    rng = random.Random(2)
    lengths = sorted((rng.randrange(1, 100) for _ in range(400)), reverse=True)
    pool = [fresh(lengths, 100, rng, 0.1 * k) for k in range(4)]
    child = crossed(pool[0], pool[3], rng)
    for g in [*pool, child, *evolved(pool, [child], rng, 5)]:
        assert sorted(i for b in g.bins for i in b) == list(range(400))
        assert [100 - sum(lengths[i] for i in b) for b in g.bins] == g.room and min(g.room) >= 0
        back = Grouping.decoded(g.encoded(), lengths, 100)
        assert back.score() == g.score()
    assert evolved(pool, [], rng, 5)[0].score() <= min(g.score() for g in pool)


def test_evolution_finds_a_better_grouping():
    # Best fit takes 6 + 3 and leaves 5 + 2 + 2 and 4 + 3 apart; three full bins exist.
    lengths, rng = [6, 5, 4, 4, 3, 3, 2, 2, 1], random.Random(3)
    best = evolved([fresh(lengths, 10, rng, 0.5 * k) for k in range(6)], [], rng, 40)[0]
    assert len(best.bins) == 3


def test_elites_reach_the_next_island(spark):
    pieces = spark.createDataFrame([(i, i, 0, 0, 1 + i % 50, 0) for i in range(300)], packing.PIECES)
    places = packing.pack_pieces(pieces, 60, islands=3, epochs=3).collect()
    assert sorted(r.uid for r in places) == list(range(300))


def alike(n):
    """Two words of n letters that any polynomial hash modulo a power of two takes for one, if n is large."""
    turns = [i.bit_count() % 2 for i in range(n)]
    return "".join("ab"[t] for t in turns), "".join("ba"[t] for t in turns)


ODD = ["a  b", "a   b c", " x", "x ", "a\n\nb", "\n a", " \n \n b", "a\r\nb c", "ünï  ço de x", "a\0b c", "1 2  3\n4", "it's I'll 'd don't", "é ́x",
       "日本 語 テスト", "a b c", "<|endoftext|> hi", "<|startoftext|>a b", "İstanbul ΣΑΣ Σ", "x\x1cy z", "a \x1c b", "tab\there now", "💩 💩💩 x", "²³ 12 ½", "", "A B c"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_by_pieces_are_the_tokenizers_own(name, spark, monkeypatch):
    path = public_tokenizers.path(name)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()] + ODD
    texts += ["x " + w for n in (512, 1024, 2048) for w in alike(n)]
    want = [reference(t, path)[:-1].tolist() for t in texts]
    led = [reference(" " + t if t else "", path)[:-1].tolist() for t in texts]
    for most, run in ((tokens.MOST_KEPT, tokens.RUN_CHARS), (5000, 3000)):
        monkeypatch.setattr(tokens, "MOST_KEPT", most)
        monkeypatch.setattr(tokens, "RUN_CHARS", run)
        own = PieceEncoder(path)
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == want
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts, led=True)] == led
        assert own.encode(texts[:5]) == own.encode(texts[:5]) and own.encode([]) == []
