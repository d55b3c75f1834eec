"""The training-data pipeline: five stages over ``documents``.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame; ``run`` writes it as Parquet into the shared folder and rereads it
for the next stage, so a lost executor costs at most one stage.  All but the last
return the columns of ``documents``.

toxicity     documents that the model calls toxic go
exact_dedup  of equal texts one row stays
ngram_join   of every group of near copies one document stays
mix_sources  three quarters of the tokens, dealt to domains, languages and sources by
             weight, every document at most once
bpe          token ids of every whole text, with digests of ids and decoded text

Null and empty texts get the score of a text without terms, equal each other in the second
stage, are linked with nothing in the third and have no ids in the last.  Rows that repeat a
document are copies of it; rows without a doc_id are judged by their text.  An empty table
passes every stage and gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from aurum.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from aurum.llm.session_tables import table, written

MIX_PERCENT = 75


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one_per_group(docs)


def mix_sources_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, percent=MIX_PERCENT, max_epochs=1)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(bpe.VOCABULARY)
    kept = docs.select("doc_id", "lang", "source", "text")
    return bpe.digested(kept, path).drop("text")


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_join", ngram_join_stage),
    ("mix_sources", mix_sources_stage),
    ("bpe", bpe_stage),
]

#: SQL expresses neither the trained toxicity model nor the tokenizer; the tests
#: hold run() against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
