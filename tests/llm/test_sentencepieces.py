import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from stratalake.llm import sentencepieces
from stratalake.llm.sentencepieces import TextEncoder, WordEncoder, decode, digests, encode
from stratalake.llm.tokens import crc32

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids string"
ODD = ["Hello  world", "  a b", "", " ", "a\tb\nc ", "日本 ü\n\nx", "<s> x</s>", "ﬁ ① Å", "a b", "\n a\n  b", "a\0b c", "   ", "x\r\n y", "💩 💩💩 x",
       " \n \n b", "Straße naïve façade être", "internationalization unbelievable hippopotamus", "a" * 40 + " " + "b" * 9, "---====", "a  \n  b", "word " * 3000]


def library(texts):
    return sentencepiece.SentencePieceProcessor(model_file=PATH).encode(texts)


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()] + ODD


def test_ids_are_the_librarys(texts):
    own = TextEncoder(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == library(texts)


def test_small_cache(texts, monkeypatch):
    monkeypatch.setattr(sentencepieces, "MOST_CACHED", 100)
    monkeypatch.setattr(sentencepieces, "MOST_PAIRS", 50)
    own = TextEncoder(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts[-30:])] == library(texts[-30:])


def test_a_literal_mark_decodes_to_a_space():
    own = TextEncoder(PATH)
    ids = own.encode(["▁ x▁y"])[0]
    assert np.frombuffer(ids, "<u4").tolist() == library(["▁ x▁y"])[0]
    assert own.decode(ids) == "  x y"


def test_unigram_paths_have_the_best_score():
    rng = random.Random(1)
    pieces = list("abc") + ["".join(p) for n in (2, 3) for p in itertools.product("abc", repeat=n) if rng.random() < 0.5]
    scores = [-rng.uniform(1, 3) * len(p) ** 0.5 for p in pieces]
    ids = {p: i for i, p in enumerate(pieces)}

    def best(word):
        if not word:
            return 0.0
        return max(scores[ids[word[:n]]] + best(word[n:]) for n in range(1, min(3, len(word)) + 1) if word[:n] in ids)

    words = sorted({"".join(rng.choices("abc", k=rng.randrange(1, 9))) for _ in range(300)})
    for word, path in zip(words, WordEncoder(ids, scores, "unigram").encode_sorted(words), strict=True):
        assert "".join(pieces[i] for i in path) == word
        assert abs(sum(scores[i] for i in path) - best(word)) < 1e-9


def test_tables_round_trip(spark, texts):
    rows = [*enumerate(texts), (1, "twice"), (1, "twice"), (None, "no id"), (900, None)]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA).repartition(4)
    coded = encode(docs, PATH, ["doc_id"])
    back = decode(coded, PATH, ["doc_id"]).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in back), key=key) == sorted(((d, t or "") for d, t in rows), key=key)
    got = sorted((tuple(r) for r in digests(docs, PATH).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    want = []
    for (d, t), ids in zip(rows, library([t or "" for _, t in rows]), strict=True):
        raw = np.array(ids, dtype="<u4").tobytes()
        want.append((d, len(ids), crc32(raw), hashlib.sha256((t or "").encode()).hexdigest(), True))
    assert got == sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[2]))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert digests(empty, PATH).collect() == [] and decode(encode(empty, PATH, []), PATH, []).collect() == []
