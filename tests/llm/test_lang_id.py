import math

import random

import numpy as np
from pyspark.sql import functions as F

from stratalake.llm import lang_id
from stratalake.llm.common import remainder_of_id
from stratalake.llm.lang_id import fitted_temperature, gram_counts, identify, train

SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string"


def table(spark, n=400):
    rng = random.Random(1)
    syllables = {"aa": ["ka", "ti", "mo"], "bb": ["sch", "ung", "ver"], "cc": ["ción", "ñe", "lla"]}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(syllables))
        rows.append((i, " ".join("".join(rng.choices(syllables[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(2, 30))), lang, "x", "y"))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_learns_languages_and_handles_odd_rows(spark):
    docs = table(spark)
    held = remainder_of_id(3) == 1
    model = train(docs.filter(~held))
    got = identify(docs, model, ["doc_id", "lang", held.alias("held")]).collect()
    assert len(got) == 400 and all(r.lang == r.lang_pred for r in got if r.held)
    assert all(0 <= r.score <= 1 for r in got)
    assert (model.weights == 0).mean() > 0.9  # the elastic net leaves few weights
    odd = [(1, None), (2, ""), (3, " 12 \n?!"), (4, "k"), (5, "UNGSCH VER"), (6, "kati " * 50000), (7, "日本"), (6, "kati " * 50000)]
    rows = identify(spark.createDataFrame([(d, t, None, "x", "y") for d, t in odd], SCHEMA), model, ["doc_id"]).collect()
    out = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert len(rows) == len(odd)
    assert out[1] == out[2] == out[3] == ("und", 1.0)
    assert out[5][0] == "bb" and out[6][0] == "aa" and out[4][0] in model.languages and out[7][0] in model.languages


def test_nothing_to_learn(spark):
    docs = table(spark, 20)
    model = train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in identify(docs, model, ["doc_id"]).collect()} == {("und", 0.0)}
    assert identify(docs.limit(0), train(docs), ["doc_id"]).collect() == []
    one = train(docs.withColumn("lang", F.lit("zz")))
    assert {r.lang_pred for r in identify(docs, one, ["doc_id"]).collect()} == {"zz"}


def test_grams_do_not_reach_into_the_next_text():
    alone = [next(gram_counts([t])) for t in ("ab cd", "x", "éa")]
    for a, b in zip(alone, gram_counts(["ab cd", "x", "éa"]), strict=True):
        assert (a == b).all()
    assert list(gram_counts([None, "", "1"])) == [None] * 3


def test_sample_is_bounded(spark):
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "aa").otherwise("bb").alias("lang"))
    sizes = {r[0]: r[1] for r in lang_id.sample_rows(rows, 500).groupBy("lang").count().collect()}
    assert all(400 < n < 600 for n in sizes.values()) and len(sizes) == 2


def test_temperature():
    rng = np.random.default_rng(1)
    logits = [rng.normal(size=3) * 8 for _ in range(500)]
    labels = [int(rng.choice(3, p=lang_id.softmax(x / 4))) for x in logits]
    assert 3 < fitted_temperature(logits, labels) < 5.5


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = remainder_of_id(3) == 1
    got = identify(docs, train(docs.filter(~held)), ["lang", held.alias("held")]).filter("held").toPandas()
    assert (got.lang == got.lang_pred).mean() >= 0.99


def plain_training(examples, n):
    """Follow the regularised leader on dictionaries, one weight at a time."""
    z, squares = [{} for _ in range(n)], [{} for _ in range(n)]

    def weight(k, j):
        v = z[k].get(j, 0.0)
        if abs(v) <= lang_id.L1:
            return 0.0
        return -(v - math.copysign(lang_id.L1, v)) / ((lang_id.BETA + math.sqrt(squares[k].get(j, 0.0))) / lang_id.RATE + lang_id.L2)

    rng = np.random.default_rng(7)
    for _ in range(lang_id.EPOCHS):
        for i in rng.permutation(len(examples)):
            at, values, label = examples[i]
            row = {**dict(zip(at.tolist(), values.tolist())), lang_id.BUCKETS: 1.0}
            own = [{j: weight(k, j) for j in row} for k in range(n)]
            sums = [sum(own[k][j] * v for j, v in row.items()) for k in range(n)]
            top = max(sums)
            shares = [math.exp(s - top) for s in sums]
            for k in range(n):
                error = shares[k] / sum(shares) - (k == label)
                for j, v in row.items():
                    g, before = error * v, squares[k].get(j, 0.0)
                    z[k][j] = z[k].get(j, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / lang_id.RATE * own[k][j]
                    squares[k][j] = before + g * g
    return weight


def test_training_against_a_plain_version():
    rng = np.random.default_rng(3)
    examples = []
    for _ in range(60):
        label = int(rng.integers(3))
        at = np.sort(rng.choice(40, 8, replace=False) + 20 * label)
        values = rng.random(8)
        examples.append((at, values / np.sqrt(values @ values), label))
    weights, weight = lang_id.follow_the_leader(examples, 3), plain_training(examples, 3)
    used = sorted({j for at, _, _ in examples for j in at.tolist()} | {lang_id.BUCKETS})
    assert np.allclose([[weight(k, j) for j in used] for k in range(3)], weights[:, used], rtol=0, atol=1e-10)
    assert not np.delete(weights, used, axis=1).any()


def test_probabilities_against_a_plain_version():
    rng = np.random.default_rng(5)
    weights = rng.normal(size=(3, lang_id.BUCKETS + 1)).astype(np.float32)
    idf = rng.random(lang_id.BUCKETS).astype(np.float32) + 1
    model = lang_id.LanguageModel(["a", "b", "c"], idf, weights, 1.7)
    counts = next(iter(lang_id.gram_counts(["Ein kurzer Text, zwei Mal Text."])))
    row = {j: math.log1p(float(counts[j])) * float(idf[j]) for j in np.flatnonzero(counts).tolist()}
    size = math.sqrt(sum(v * v for v in row.values()))
    sums = [(sum(float(weights[k, j]) * v / size for j, v in row.items()) + float(weights[k, -1])) / 1.7 for k in range(3)]
    shares = [math.exp(s) for s in sums]
    assert np.allclose(model.probabilities(counts), [s / sum(shares) for s in shares], atol=1e-6)
