import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aurum.llm import bpe as B
from conftest import SF_SMALL

PARTS = ["a", "b", "the", " ", "  ", "   ", "\n", "\n\n", "\t", "\r\n", "'s", "'ll", "é", "ß", "日本", "١", "²", "½", "́", "\xa0",
         " ", "\x1c", "\x85", "\x00", "🙂", "<|endoftext|>", "<|", "!!", "...", "1234", "Zz", "'", "_", "-", "aaaa", "ing", "tion", " the"]


@pytest.fixture(scope="module")
def pair():
    path = public_tokenizers.path(B.VOCABULARY)
    return B.load(path), Tokenizer.from_file(path)


def same(pair, text):
    mine, lib = pair
    ids = mine.encode(text).tolist()
    assert ids == lib.encode(text, add_special_tokens=False).ids
    assert mine.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_random_mixtures(pair):
    rnd = random.Random(3)
    for _ in range(4000):
        same(pair, "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14))))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(pair, text):
    same(pair, text)


def test_runs_and_long_words(pair):
    for text in ("a" * 5000, "ab" * 1000, "=" * 777, " " * 300 + "x", "aab" * 50, "x" + " " * 40):
        same(pair, text)


def test_tables_start_anew(pair, monkeypatch):
    monkeypatch.setattr(B, "KEPT_CUTS", 3)
    monkeypatch.setattr(B, "KEPT_PAIRS", 3)
    same(pair, "many different words in one text, and then some more of the many words")


def test_columns_and_edge_rows(spark):
    path = public_tokenizers.path(B.VOCABULARY)
    df = spark.createDataFrame([(1, "Hello  wörld", 5), (2, None, 6), (3, "", 7), (3, "", 7)], "doc_id bigint, text string, n_tokens int")
    ids = B.encoded(df, path)
    back = B.decoded(ids.drop("text"), path).orderBy("doc_id").collect()
    assert [r.text for r in back] == ["Hello  wörld", "", "", ""]
    out = B.digested(df, path)
    assert out.columns == ["doc_id", "text", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == 4
    assert B.bpe_round_trip(df.limit(0)).count() == 0


def test_query_agrees_with_the_library(spark, pair):
    import hashlib
    lib = pair[1]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in B.bpe_round_trip(docs).collect()}
    texts = docs.select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for r, e in zip(texts, lib.encode_batch([t.text for t in texts], add_special_tokens=False)):
        have = rows[r.doc_id]
        assert have.n_tokens == len(e.ids)
        assert have.ids_sha256 == hashlib.sha256(",".join(map(str, e.ids)).encode()).hexdigest()
        assert have.decoded_sha256 == hashlib.sha256(lib.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()
    assert isinstance(pair[0].encode("x"), np.ndarray)


def test_plain_words_skip_the_pattern(pair, monkeypatch):
    mine = pair[0]
    mine.cuts.clear()
    mine.cuts.old = {}
    used = []
    find = mine.pieces
    monkeypatch.setattr(mine, "pieces", lambda text: used.append(text) or find(text))
    text = "Undeinber zwölfköpfigö, thonrewh laescobo. Ciónñí! wh"
    same(pair, text)
    assert used == []
    same(pair, text + " a1")
    assert used == [" a1"]


def test_white_space_at_cuts(pair):
    rnd = random.Random(5)
    parts = [" ", "\n", "\t", "\x0b", "\xa0", "\x1d", "　", "\0", "a", "Öl", "ab.", "x,", ".", "7", "é!", "<|endoftext|>"]
    for _ in range(6000):
        same(pair, "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 9))))


def test_tables_end_with_the_task(spark):
    path = public_tokenizers.path(B.VOCABULARY)
    docs = spark.range(64).selectExpr("id AS doc_id", "concat('wörter', id, ' undeinber ', repeat('thonre', int(id))) AS text")
    assert B.digested(docs.repartition(16), path).filter("n_tokens > 3").count() == 64

    def kept(batches):
        import pyarrow as pa
        for _ in batches:
            pass
        bpe = B.load(path)
        yield pa.record_batch([pa.array([len(t) + len(t.old) for t in (bpe.cuts, bpe.pair)])], names=["n"])

    left = spark.range(0, 64, 1, 64).mapInArrow(kept, "n bigint").collect()
    assert len(left) == 128 and not any(r.n for r in left)
