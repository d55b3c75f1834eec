"""run() against a version that uses none of its Spark code but the trained model."""
import hashlib
import re

import duckdb
import pyarrow as pa
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from aurum.llm import bpe, oracle, toxicity
from conftest import SF_SMALL
from test_ngram_join import brute as components


def test_stages_are_the_five_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "mix_sources", "bpe"]


def test_run_agrees_with_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = [r for r in docs.orderBy("doc_id").collect() if model.scores(pa.array([r.text]))[0] < toxicity.THRESHOLD]
    assert 0 < len(rows) < docs.count()
    best = {}
    for r in rows:
        k = re.sub(r"[\x20\x09-\x0D]", "", r.text)
        best[k] = min(best.get(k, (1, 0)), (-len(r.text), r.doc_id))
    keep = {d for _, d in best.values()}
    rows = [r for r in rows if r.doc_id in keep]
    keep = {c for _, _, c in components([(r.doc_id, r.text) for r in rows])}
    rows = [r for r in rows if r.doc_id in keep]
    con = duckdb.connect()
    con.register("kept", pa.table({c: [r[c] for r in rows] for c in ("doc_id", "text", "lang", "source")}))
    cur = con.execute(oracle.mixing_sql("kept", percent=P.MIX_PERCENT, max_epochs=1))
    at = [d[0] for d in cur.description].index("doc_id")
    chosen = {r[at] for r in cur.fetchall()}
    assert 0 < len(chosen) < len(rows)
    lib = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    want = []
    for r in rows:
        if r.doc_id in chosen:
            ids = lib.encode(r.text, add_special_tokens=False).ids
            want.append((r.doc_id, r.lang, r.source, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(r.text.encode()).hexdigest()))
    assert sorted(map(tuple, P.run(spark, SF_SMALL).collect())) == sorted(want)


def test_every_stage_takes_an_empty_table(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").filter(F.lit(False)).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_all_but_the_last_stage_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns
