import numpy as np
import public_tokenizers
from pyarrow import orc
from tokenizers import Tokenizer

from stratalake.llm.orc_tokens import read_tokens, token_digests, write_tokens
from stratalake.llm.tokens import crc32

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string, start string"


LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


def test_files_hold_all_ids_in_order(spark, tmp_path):
    rows = [(i * 3 % 101, f"Text {i} " + "word " * (i % 40)) for i in range(101)] + [(5, None), (7, ""), (900, "long " * 9000), (None, "no id")]
    rows += [(50, "twice"), (50, "twice")]
    path = str(tmp_path / "tokens")
    write_tokens(spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA).repartition(4), path, PATH)
    got = sorted((tuple(r) for r in token_digests(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] is not None and r[0] for r in got] == sorted((d is not None and d for d, _ in rows))
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    want = sorted((d is not None and d, len(ids_of(t)), crc32(np.array(ids_of(t), "<u4").tobytes())) for d, t in rows)
    assert sorted((d is not None and d, n, c) for d, _, n, c in got) == want
    chosen = {r.doc_id: list(r.ids) for r in read_tokens(spark, path, [7, 900, 123456]).filter("n_tokens != 1 or doc_id = 7").collect() if r.doc_id == 900}
    assert chosen == {900: ids_of("long " * 9000)}
    pushed = read_tokens(spark, path, [7])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in pushed or "In(doc_id" in pushed
    files = sorted((tmp_path / "tokens").glob("*.orc"))
    assert sum(orc.ORCFile(f).nrows for f in files) == len(rows)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "tokens")
    write_tokens(spark.createDataFrame([], SCHEMA), path, PATH)
    assert token_digests(spark, path).collect() == []
