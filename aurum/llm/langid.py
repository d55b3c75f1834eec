"""Language identification by averaged hashed subword embeddings.

Subwords are the runs of 2, 3 and 4 bytes of a text in which every byte that is
not part of a letter (ASCII letters, A-Z folded, and bytes from 0x80 on) reads as
a space.  Each subword is hashed to one of 2**BITS rows of an embedding matrix; a
text is the average of its subwords' rows and a linear softmax over the learned
languages scores it.  Embeddings and softmax are trained together by stochastic
gradient descent in numpy on at most ``TRAIN_PER_LANG`` documents per language,
chosen by a hash of their id.  As averaging is linear, prediction adds up one
small table (embedding times softmax) over the whole text.

A fifth of the sample is held back to calibrate: a temperature makes the softmax
score a probability, and the rejection level is the smallest score above which
the held-back documents reach ``PRECISION``.  Rejected texts keep their best
language in ``lang_pred`` and are marked in ``rejected``.

Null texts and texts without a letter are ``und`` with score 0.  With no language
to learn from, every text is ``und``.  Only doc_id, text and (for learning) lang
are read; rows with a null doc_id or lang are never learnt from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aurum.llm.textarrays import bounded_batches, slices, text_buffers
from aurum.llm.training import Sparse, fold, list_column, one_per_id, per_batch, row_sums

BITS = 15
ORDERS = (2, 3, 4)
DIM = 16
#: Bound of the training sample.
TRAIN_PER_LANG = 500
SAMPLE_PARTS = 64
EPOCHS = 8
RATE = 2.0
PRECISION = 0.995
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
for _c in [*range(65, 91), *range(97, 123)]:
    _FOLD[_c] = _c | 32
_FOLD[128:] = np.arange(128, 256)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MUL = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


def subwords(texts: pa.Array):
    """Yields, for runs of texts, (row offsets in bytes, [feature numbers per order]).

    ``features[k][i]`` is the subword of order ``ORDERS[k]`` at byte ``i``;
    2**BITS stands for "none" (it would reach over the end of its text)."""
    offs, raw = text_buffers(texts)
    for i, j in slices(offs):
        lo, hi = int(offs[i]), int(offs[j])
        data = _FOLD[raw[lo:hi]].astype(np.uint32)
        rows = offs[i:j + 1] - lo
        n, out = hi - lo, []
        for order in ORDERS:
            h = np.zeros(n, np.uint32)
            m = max(0, n - order + 1)
            for k in range(order):
                h[:m] += data[k:k + m] * _MUL[k]
            h *= np.uint32(0x2C1B3C6D + 2 * order)
            f = (h >> np.uint32(32 - BITS)).astype(np.int32)
            for k in range(1, order):                      # the last bytes of every text start none
                at = rows[1:] - k
                f[at[at >= rows[:-1]]] = 1 << BITS
            out.append(f)
        yield rows, out


def has_letter(texts: pa.Array) -> np.ndarray:
    offs, raw = text_buffers(texts)
    out = np.zeros(len(offs) - 1, bool)
    for i, j in slices(offs):
        lo, hi = int(offs[i]), int(offs[j])
        rows = offs[i:j + 1] - lo
        out[i:j] = row_sums(_ASCII_LETTER[raw[lo:hi]], rows) > 0
        for r in np.flatnonzero(~out[i:j]):                # rare: no ASCII letter at all
            text = raw[lo + rows[r]:lo + rows[r + 1]].tobytes().decode("utf-8", "replace")
            out[i + r] = any(map(str.isalpha, text))
    return out


class LanguageModel:
    """``table`` (2**BITS + 1, languages): embeddings times softmax; bias; temperature."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, heat: float = 1.0, level: float = 0.0):
        self.langs, self.table, self.bias, self.heat, self.level = langs, table, bias, heat, level

    def logits(self, texts: pa.Array) -> np.ndarray:
        parts = []
        for rows, feats in subwords(texts):
            total = np.zeros((len(rows) - 1, len(self.langs)))
            for order, f in zip(ORDERS, feats):
                total += row_sums(self.table[f], rows)
            size = np.diff(rows)
            count = sum(np.maximum(size - order + 1, 0) for order in ORDERS)
            parts.append(total / np.maximum(count, 1)[:, None] + self.bias)
        return np.concatenate(parts) if parts else np.zeros((0, len(self.langs)))

    def predict(self, texts: pa.Array) -> pa.Array:
        ok = has_letter(texts)
        if not self.langs:
            ok[:] = False
            best, score = np.zeros(len(ok), int), np.zeros(len(ok))
        else:
            p = softmax(self.logits(texts) / self.heat)
            best, score = p.argmax(axis=1), np.where(ok, p.max(axis=1), 0.0)
        name = [self.langs[b] if o else UNKNOWN for b, o in zip(best, ok)]
        return pa.StructArray.from_arrays([pa.array(name, pa.string()), pa.array(score),
                                           pa.array(~ok | (score < self.level))], ["lang_pred", "score", "rejected"])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: Sparse, y: np.ndarray, langs: list[str], seed: int = 11) -> LanguageModel:
    """SGD over documents given as subword counts; calibrated on every fifth one."""
    if not langs:
        return LanguageModel([], np.zeros(((1 << BITS) + 1, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    back = np.arange(len(y)) % 5 == 4
    fit, held = np.flatnonzero(~back), np.flatnonzero(back)
    emb = rng.normal(0, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    soft, bias = rng.normal(0, 1 / DIM, (DIM, len(langs))), np.zeros(len(langs))
    total = np.maximum(row_sums(x.value, x.at), 1.0)
    steps, step = EPOCHS * max(1, -(-len(fit) // 32)), 0
    for _ in range(EPOCHS):
        order = rng.permutation(fit)
        for lo in range(0, len(order), 32):
            which = order[lo:lo + 32]
            b = x.rows(which)
            share = (b.value / total[which][b.row_of()]).astype(np.float32)
            mean = row_sums(emb[b.index] * share[:, None], b.at)
            err = softmax(mean @ soft + bias)
            err[np.arange(len(which)), y[which]] -= 1.0
            rate = RATE * (1 - step / steps) / len(which)
            pull = err @ soft.T
            soft -= rate * mean.T @ err
            bias -= rate * err.sum(axis=0)
            # every document's gradient reaches its subwords by their share; scaled up because shares are tiny
            np.add.at(emb, b.index, share[:, None] * (-rate * 64 * pull).astype(np.float32)[b.row_of()])
            step += 1
    table = np.zeros(((1 << BITS) + 1, len(langs)), np.float32)
    table[:-1] = emb @ soft
    model = LanguageModel(langs, table, bias)
    if len(held):
        b = x.rows(held)
        z = row_sums(table[b.index] * b.value[:, None], b.at) / total[held][:, None] + bias
        heats = np.geomspace(0.02, 5, 60)
        loss = [-np.log(softmax(z / t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in heats]
        model.heat = float(heats[int(np.argmin(loss))])
        p = softmax(z / model.heat)
        score, right = p.max(axis=1), p.argmax(axis=1) == y[held]
        down = np.argsort(-score)
        precision = np.cumsum(right[down]) / np.arange(1, len(down) + 1)
        good = np.flatnonzero(precision >= PRECISION)
        model.level = float(score[down][good[-1]]) if len(good) else 1.0
    return model


def sample(docs: DataFrame, per_lang: int = TRAIN_PER_LANG) -> DataFrame:
    """Ids and languages to learn from, every id once: crc32 of the id modulo 3 is not 1."""
    able = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", 3) != 1))
    able = able.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    rows = able.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).withColumn("part", F.pmod("h", F.lit(SAMPLE_PARTS)))
    # first within parts of a language, then within the language: no task sees a whole language
    for keys in (["lang", "part"], ["lang"]):
        first = Window.partitionBy(*keys).orderBy("h", "doc_id")
        rows = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per_lang).drop("n")
    return rows.select("doc_id", F.col("lang").alias("_lang"))


def fit(docs: DataFrame, per_lang: int = TRAIN_PER_LANG) -> LanguageModel:
    rows = docs.filter(F.col("text").isNotNull()).select("doc_id", F.col("lang").alias("_lang"), "text")
    chosen = one_per_id(rows.join(F.broadcast(sample(docs, per_lang)), ["doc_id", "_lang"]), "_lang")   # bounded per language

    def counts(batch: pa.RecordBatch) -> pa.RecordBatch:
        index, value = [], []
        for rows, feats in subwords(batch.column("text")):
            for a, b in zip(rows[:-1], rows[1:]):
                ids, n = np.unique(np.concatenate([f[a:b] for f in feats]), return_counts=True)
                real = ids < 1 << BITS
                index.append(ids[real])
                value.append(n[real].astype(np.float32))
        return pa.record_batch([batch.column("doc_id"), batch.column("_lang"), list_column(index, pa.int32()),
                                list_column(value, pa.float32())], names=["doc_id", "_lang", "ids", "n"])

    made = chosen.mapInArrow(per_batch(counts), "doc_id bigint, _lang string, ids array<int>, n array<float>").toArrow()
    made = made.sort_by([("doc_id", "ascending"), ("_lang", "ascending")])
    names = made.column("_lang").to_pylist()
    langs = sorted(set(names))
    x = Sparse.of_lists([r.values.to_numpy() for r in made.column("ids")], [r.values.to_numpy() for r in made.column("n")])
    return train(x, np.array([langs.index(n) for n in names], np.int64), langs)


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    bounded_batches(docs.sparkSession)
    model = fit(docs) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)       # a fixed size per language

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def predict(text: pa.Array) -> pa.Array:
        return shared.value.predict(text)

    out = docs.select("doc_id", predict(F.col("text")).alias("p"))
    return out.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                      "p.lang_pred", "p.score", "p.rejected")
