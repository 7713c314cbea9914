"""From raw documents to packed training sequences.

Stages, in order: language identification (documents without a language go), toxicity (toxic
documents go), near duplicates by the n-gram Jaccard join (one document of each group stays, the
one with the smallest id), and packing. All but the last return the columns of `documents`.

A document without text or without letters has no language and goes in the first stage; how sure the model is of a
language doesn't matter. Rows without an id pass the near-duplicate stage; of rows that share an
id the one with the smallest text stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import lang_id, packing, partenum, toxicity
from stratalake.llm.common import read_table, remainder_of_id, written

BROADCAST_BYTES = 32 * 1024**2


def renamed(docs: DataFrame) -> DataFrame:
    """Columns that can't clash with those an operator adds."""
    return docs.toDF(*[f"_{c}" for c in docs.columns])


def restored(docs: DataFrame) -> list[Column]:
    return [F.col(f"`_{c}`").alias(c) for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learnable = F.coalesce(remainder_of_id(3) != 1, F.lit(False))
    model = lang_id.train(docs.filter(learnable))
    judged = lang_id.identify(renamed(docs), model, text="_text")
    return judged.filter(F.col("lang_pred") != lang_id.UNKNOWN).select(*restored(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learnable = F.coalesce(remainder_of_id(4) != 2, F.lit(False))
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels").filter(learnable))
    judged = toxicity.judge(renamed(docs), model, text="_text")
    return judged.filter(F.col("predicted") == 0).select(*restored(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = written(partenum.similar_documents(docs), "similar_documents")
    removed = found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    # Ids that fit every executor spare a shuffle of all texts; more of them meet the texts in one.
    small = 16 * removed.count() <= BROADCAST_BYTES
    kept = docs.join(F.broadcast(removed) if small else removed, "doc_id", "left_anti")
    repeated = found.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if not repeated.isEmpty():
        again = kept.join(repeated, "doc_id", "left_semi")
        first = F.struct(F.col("text"), F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns]))
        once = again.groupBy("doc_id").agg(F.min_by(F.struct(*again.columns), first).alias("row")).select("row.*")
        kept = kept.join(repeated, "doc_id", "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("packing", pack_sequences),
]

# The stages learn models, join by similarity and search for groupings: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`, each stage's rows written before the next one reads them."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
