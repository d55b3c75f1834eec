import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aurum.llm import token_store as S
from aurum.session import scratch_path
from conftest import SF_SMALL

PARTS = ["a", "B", "The", " ", "  ", "\n", "\t", "\r\n", "'s", "'LL", "é", "É", "日本", "١", "½", "é", "́", "\xa0", " ",
         "\x1c", "\x85", "\x00", "🙂", "<|endoftext|>", "<|", "!!", "...", "1234", "Zz.", "Σ", "ΑΣ.", "İ", "'", "_", "ing,", "tion."]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(public_tokenizers.path(S.VOCABULARY))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=700), st.integers(1, 1 << 20))
def test_elias_fano(values, cut):
    v = sorted(x // cut for x in values)
    e = S.EliasFano(S.ef_encode(np.array(v, np.uint64)))
    assert e.all().tolist() == v
    assert [e.select(i) for i in range(len(v))] == v


def test_boundaries_take_a_few_bits_each():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20_000))
    assert 8 * len(S.ef_encode(ends)) / len(ends) < 14


def test_chunks_get_the_ids_of_whole_texts(lib):
    enc, rnd = S.load(public_tokenizers.path(S.VOCABULARY)), random.Random(4)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    made = [np.frombuffer(b, enc.width).tolist() for b in enc.encode_all(texts)]
    assert made == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_marks_behind_letters_that_grow_when_lowered(lib):
    enc = S.ChunkEncoder(public_tokenizers.path(S.VOCABULARY))
    texts = [a + b + c for a in ["TEKNOLOJİ", "İ", "aİ", "ÉCOLE", "Straße", "x", "ΑΣ", "µ", "ª", "don't", "é1", ""]
             for b in [".", ",", "!", "?", "?!.", "###", "$%&", "'s", ";:", "*", "|", "<|"] for c in ["", " ile", "\u0301", "z"]]
    made = [np.frombuffer(b, enc.width).tolist() for b in enc.encode_all(texts)]
    assert made == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_random_strings(lib):
    enc, rnd = S.ChunkEncoder(public_tokenizers.path(S.VOCABULARY)), random.Random(11)
    parts = PARTS + [".", ",", "!", "?", "#", "&", "ß", "ÿ", "ŀ", "ǆ", "ﬁ", "K", "ı", "don't", "É.", "\xad"]
    for _ in range(10):
        texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 9))) for _ in range(5000)]
        made = [np.frombuffer(b, enc.width).tolist() for b in enc.encode_all(texts)]
        assert made == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_pieces_are_those_of_the_pre_tokenizer(lib):
    rnd = random.Random(13)
    parts = [chr(c) for c in range(256)] + ["'s", "'t", "'re", "'VE", "'m", "'ll", "'d", "'l", "'r", "'v", "''", "ab", "É", "'", "\n"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))).replace("<|", "<") for _ in range(20_000)]
    texts += ["", "don't", "we'll", "t'", "s", "'", "'s's", "x'r", "'l", "l", "½½1²", "\xa0\x85", "", "a"]
    pieces, ends = S.cut_pieces(texts)
    pieces = pieces.to_pylist()
    for t, lo, hi in zip(texts, [0, *ends.tolist()], ends.tolist()):
        low = lib.normalizer.normalize_str(t)
        assert pieces[lo:hi] == [low[a:b] for _, (a, b) in lib.pre_tokenizer.pre_tokenize_str(low)]


def test_only_chunks_beyond_latin_1_stay_whole():
    pieces, ends = S.cut_pieces(["It's ÉA. “Q&A\tB” C!\nD<|E F", "日本 X1", "", " ", "Ğ"])
    assert pieces.to_pylist() == ["it", "'s", "éa", ".", "“Q&A\tB”", "c", "!", "D<|E", "f", "日本", "x", "1", "Ğ"]
    assert ends.tolist() == [9, 12, 12, 12, 13]


def test_python_sees_distinct_pieces_only(lib):
    enc, seen = S.ChunkEncoder(public_tokenizers.path(S.VOCABULARY)), []
    ids = enc._ids
    enc._ids = lambda pieces: seen.extend(pieces) or ids(pieces)
    texts = ["The cat, the dog's 22 naïve cats. “The” " * 300, "", "the cat " * 500]
    made = [np.frombuffer(b, enc.width).tolist() for b in enc.encode_all(texts)]
    assert made == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert sorted(seen) == sorted(["the", "cat", ",", "dog", "'s", "2", "naïve", "cats", ".", "“The”"])


def test_memory_of_chunks_is_bounded_in_bytes(lib, monkeypatch):
    monkeypatch.setattr(S, "KEPT_BYTES", 20_000)
    enc, rnd = S.ChunkEncoder(public_tokenizers.path(S.VOCABULARY)), random.Random(5)
    free_of_spaces = ["".join(rnd.choice("日本語文字列") for _ in range(3000)) for _ in range(3)]
    texts = free_of_spaces + [" ".join(f"{rnd.randrange(5000)}ab{'c' * rnd.randrange(5)}" for _ in range(300)) for _ in range(20)]
    for t in texts + texts:
        assert np.frombuffer(enc.encode_all([t])[0], enc.width).tolist() == lib.encode(t, add_special_tokens=False).ids
        assert all(len(c) <= S.KEPT_CHARS for d in (enc.young, enc.old) for c in d)
        assert sum(S.ENTRY_BYTES + 2 * len(c) + len(i) for d in (enc.young, enc.old) for c, i in d.items()) <= 21_000


def test_hot_id_long_text_and_no_id(spark, lib):
    long = "Long words, and more. " * 40_000
    rows = [(7, f"t{i % 50} x") for i in range(600)] + [(None, "none here")] * 300 + [(8, long), (9, "end")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    out = S.store_round_trip(df).orderBy("start").collect()
    assert [r.doc_id for r in out] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    assert [r.start for r in out] == np.concatenate(([0], np.cumsum([r.n_tokens for r in out])[:-1])).tolist()
    crc = {t: zlib.crc32(np.array(lib.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes()) for _, t in rows}
    assert sorted(r.ids_crc32 for r in out) == sorted(crc[t] for _, t in rows)


def test_round_trip_of_the_given_table(spark, lib):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows, at = {r.doc_id: r for r in S.store_round_trip(docs).collect()}, 0
    for d in docs.orderBy("doc_id").collect():
        ids = lib.encode(d.text, add_special_tokens=False).ids + [1]
        r = rows[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_small_shards_nulls_repeats_and_lookup(spark, lib):
    df = spark.createDataFrame([(3, None, 1), (None, "a b", 2), (1, "", 3), (1, "x y z", 4), (-5, "q", 5), (None, "a b", 6)],
                               "doc_id bigint, text string, start int")
    folder = scratch_path(spark, "tokens")
    manifest = S.write_store(df, folder, shard_tokens=2)
    out = S.read_store(spark, folder, manifest).orderBy("start").collect()
    assert [r.doc_id for r in out] == [None, None, -5, 1, 1, 3]
    assert [r.start for r in out] == np.concatenate(([0], np.cumsum([r.n_tokens for r in out])[:-1])).tolist()
    one = S.read_shard(folder, manifest.orderBy("part", "serial").first().file)
    assert one.document(0).tolist() == lib.encode("a b").ids + [1]
    assert S.store_round_trip(df.limit(0)).count() == 0
