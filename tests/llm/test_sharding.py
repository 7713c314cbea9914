import os
from collections import defaultdict

import pytest

from stratalake.llm.sharding import assign, write_shards

SCHEMA = "doc_id long, text string, shard string, depth int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(3)


def check(rows, limit, got, most_bits=60):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes) for r in got) == sorted((d is None, d or 0, len((t or "").encode())) for d, t in rows)
    sums, keys = defaultdict(int), defaultdict(set)
    for r in got:
        sums[r.shard] += r.n_bytes
        keys[r.shard].add(r.doc_id)
        assert len(r.shard) == r.depth
    for r in got:
        assert r.shard_bytes == sums[r.shard]
        assert r.oversize == (sums[r.shard] > limit)
        assert not r.oversize or len(keys[r.shard]) == 1
    shards = set(sums)
    for s in shards:  # no shard lies in another, and each split was needed
        assert not any(s[:i] in shards for i in range(len(s)))
        if s:
            parent = [n for t, n in sums.items() if t.startswith(s[:-1])]
            held = {k for t, k in keys.items() if t.startswith(s[:-1]) for k in k}
            assert sum(parent) > limit and len(held) > 1


@pytest.mark.parametrize("limit", [30, 200, 10**6])
def test_shards_fit_and_split_only_when_needed(spark, limit):
    rows = [(i, "x" * (i * 7 % 90)) for i in range(300)] + [(3, "é" * 40)] * 4 + [(None, "null"), (None, None), (500, ""), (501, "y" * 5000)]
    check(rows, limit, assign(frame(spark, rows), ["doc_id"], limit).collect())


def test_deeper_rounds(spark):
    rows = [(i, "x" * 10) for i in range(500)] + [(7, "z" * 10**5), (8, "z" * 10**5)]
    got = assign(frame(spark, rows), ["doc_id"], 15).collect()
    check(rows, 15, got)


def test_empty_table(spark):
    assert assign(frame(spark, []), ["doc_id"], 10).collect() == []


def test_written_shards(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(50)]
    path = str(tmp_path / "shards")
    write_shards(frame(spark, rows), path, 60)
    back = spark.read.schema("doc_id long, text string, shard string").parquet(path)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == rows
    assert len([d for d in os.listdir(path) if d.startswith("shard=")]) > 4
