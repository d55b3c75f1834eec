"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from aurum.llm import oracle
from aurum.llm.bpe import bpe_round_trip
from aurum.llm.exact_dedup import exact_dedup
from aurum.llm.kdtree_topk import topk
from aurum.llm.langid import identify
from aurum.llm.merkle import audit
from aurum.llm.mixing import mix
from aurum.llm.ngram_join import ngram_join
from aurum.llm.oracle_quality import quality_sql
from aurum.llm.oracle_trees import MERKLE, TRIE
from aurum.llm.prefix_trie import prefix_trie
from aurum.llm.quality_rules import quality
from aurum.llm.session_tables import table
from aurum.llm.token_store import store_round_trip
from aurum.llm.toxicity import toxicity
from aurum.llm.url_filter import url_filter
from aurum.llm.warc import warc_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@query("op2_exact_dedup", oracle.EXACT_DEDUP)
def op2_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op3_url_filter", oracle.url_filter_sql())
def op3_url_filter(spark, sf_dir):
    return url_filter(table(spark, sf_dir, "pages")).drop("template")


@query("op8_mix_sources", oracle.mixing_sql())
def op8_mix_sources(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))


@query("op9_ngram_join")
def op9_ngram_join(spark, sf_dir):
    return ngram_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


@query("op1_language_id")
def op1_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_token_store")
def op4_token_store(spark, sf_dir):
    return store_round_trip(table(spark, sf_dir, "documents"))


@query("op6_bpe")
def op6_bpe(spark, sf_dir):
    return bpe_round_trip(table(spark, sf_dir, "documents"))


@query("op5_topk", oracle.TOPK)
def op5_topk(spark, sf_dir):
    return topk(table(spark, sf_dir, "embeddings"))


@query("op7_warc", oracle.WARC)
def op7_warc(spark, sf_dir):
    return warc_round_trip(table(spark, sf_dir, "pages"))


@query("op11_quality_rules", quality_sql())
def op11_quality_rules(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op12_merkle_manifest", MERKLE)
def op12_merkle_manifest(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"))


@query("op13_prefix_trie", TRIE)
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
