import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aurum.llm import langid as L
from aurum.llm import toxicity as X
from aurum.llm.training import Sparse
from conftest import SF_SMALL

SF = SF_SMALL.replace("sf0.001", "sf0.1")


# ------------------------------------------------------------ language
def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    r = out.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("acc"),
                                   F.avg(F.when(~F.col("rejected"), (F.col("lang") == F.col("lang_pred")).cast("int"))).alias("sure"),
                                   F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r.acc > 0.98 and r.sure >= r.acc and 0 <= r.lo <= r.hi <= 1
    assert out.filter("held_out").count() == sum(zlib.crc32(str(x.doc_id).encode()) % 3 == 1 for x in docs.select("doc_id").collect())


def test_language_edges(spark):
    schema = "doc_id bigint, text string, lang string, score int"
    rows = [(1, None, "en", 0), (2, "", "en", 0), (3, "123 !!", "de", 0), (4, "ÄÖ", None, 0), (None, "the and", "en", 0), (5, "日本", "ja", 0),
            (6, "hello world the and of", "en", 0), (6, "hello world the and of", "en", 0), (7, "la le les une des", "fr", 0), (9, "x " * 200_000, "en", 0)]
    out = L.identify(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == len(rows)
    for r in out:
        und = r.doc_id in (1, 2, 3)
        assert (r.lang_pred == "und") == und and 0 <= r.score <= 1 and (not und or r.score == 0)
    assert L.identify(spark.createDataFrame([], schema)).count() == 0
    nothing = L.identify(spark.createDataFrame([(1, "abc", None, 0)], schema)).first()
    assert nothing.lang_pred == "und"


def test_held_out_languages_are_not_read(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    lied = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit("zz")).otherwise(F.col("lang")))
    assert sorted(map(tuple, L.identify(docs).collect()), key=str) == sorted(map(tuple, L.identify(lied).collect()), key=str)


def test_table_is_the_average_of_embeddings_times_softmax():
    texts = pa.array(["abcd ef", "zz"])
    (rows, feats), = L.subwords(texts)
    rng = np.random.default_rng(0)
    emb, soft = rng.normal(size=((1 << L.BITS) + 1, 4)), rng.normal(size=(4, 3))
    emb[-1] = 0
    model = L.LanguageModel(["a", "b", "c"], emb @ soft, np.zeros(3))
    for i, z in enumerate(model.logits(texts)):
        used = np.concatenate([f[rows[i]:rows[i + 1]] for f in feats])
        used = used[used < 1 << L.BITS]
        assert np.allclose(z, emb[used].mean(axis=0) @ soft)


# ------------------------------------------------------------ toxicity
def test_toxicity_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = X.toxicity(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").filter("held_out")
    toxic = F.col("toxic") == 1
    insult = F.lower("text").rlike("idiot|moron|loser|trash|scum|clown|stupid|pathetic|worthless|disgusting")
    r = out.agg(F.avg(F.when(toxic, F.col("predicted"))).alias("recall"),
                F.avg(F.when(toxic & insult, F.col("predicted"))).alias("worded"),
                F.avg(F.when(~toxic, F.col("predicted"))).alias("false_alarms")).first()
    # about an eighth of the toxic labels sit on documents without a word that clean ones lack
    assert r.worded > 0.95 and r.recall > 0.8 and r.false_alarms < 0.01


def test_pairs_weigh_more_than_their_terms():
    """An insult alone or a group alone is clean, together they are toxic."""
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(60)]
    texts, y = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.4, rng.random() < 0.4
        t = list(rng.choice(words, 8)) + ["insult"] * a + ["group"] * b
        texts.append(" ".join(rng.permutation(t)))
        y.append(float(a and b))
    lists = [ix[p:q] for at, ix in X.features(pa.array(texts)) for p, q in zip(at[:-1], at[1:])]
    model = X.train(Sparse.of_lists(lists), np.array(y))
    s = model.scores(pa.array(["w1 insult w2", "w1 group w2", "w1 insult w2 group", "", None]))
    assert s[2] > 0.9 and max(s[0], s[1], s[3], s[4]) < 0.3
    flat = X.FactorizationMachine(model.w0, model.w, np.zeros_like(model.v))
    z = flat.scores(pa.array(["insult group"]))
    assert z[0] < s[2]                                              # the pair term carries the decision


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (None, "you idiot", 5), (3, "fine text", 5), (3, "fine text", 5), (4, "x " * 300_000, 5)],
                                 "doc_id bigint, text string, score int")
    schema = "doc_id bigint, quality int, toxic int"
    for labels in ([], [(1, 1, None), (None, 1, 1)], [(3, 0, 0), (4, 0, 0)], [(3, 0, 0), (4, 0, 1), (4, 0, 1), (1, 1, 0)]):
        out = X.toxicity(docs, spark.createDataFrame(labels, schema)).collect()
        assert len(out) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    kept = X.drop_toxic(docs, spark.createDataFrame([], schema))
    assert kept.columns == docs.columns and kept.count() == 6
    assert X.toxicity(docs.limit(0), spark.createDataFrame([], schema)).count() == 0


def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    lied = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(map(tuple, X.toxicity(docs, labels).collect()), key=str) == sorted(map(tuple, X.toxicity(docs, lied).collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 7])
def test_margins_are_the_pairwise_sum(n):
    rng = np.random.default_rng(n)
    model = X.FactorizationMachine(0.3, rng.normal(size=1 << X.BITS), rng.normal(size=(1 << X.BITS, X.FACTORS)))
    ix = rng.choice(1 << X.BITS, n, replace=False)
    want = 0.3 + sum(model.w[i] for i in ix) + sum(model.v[ix[a]] @ model.v[ix[b]] for a in range(n) for b in range(a))
    assert np.isclose(model.margins(ix, np.array([0, n]))[0], want)


def test_samples_hold_for_one_id_on_many_rows(spark, monkeypatch):
    """A third of all rows share an id; each sampled id is learnt from once."""
    ids = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 3 != 1 and zlib.crc32(str(i).encode()) % 4 != 2][:40]
    rows = [(i, f"some words {i} here", "en") for i in ids] + [(ids[0], f"copy {j} of it", "en") for j in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    monkeypatch.setattr(L, "train", lambda x, y, langs: len(x))
    monkeypatch.setattr(X, "train", lambda x, y: len(x))
    assert L.fit(docs, per_lang=100) == len(ids) and L.fit(docs, per_lang=7) == 7
    labels = docs.selectExpr("doc_id", "1 AS toxic")
    assert X.fit(docs, labels, limit=100) == len(ids)
