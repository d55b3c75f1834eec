"""Toxicity scores from a factorization machine over hashed terms.

Terms are runs of letters (ASCII letters, A-Z folded, and every byte from 0x80
on), plus their first four and five bytes, hashed into 2**BITS features; a text
has a feature or not.  The machine scores

    w0 + sum_i w_i + sum_{i<j} <v_i, v_j>      over the features of the text,

so a pair of terms (an insult with a group mention, say) can weigh more than the
two terms alone.  It is trained here, in numpy, by AdaGrad on the logistic loss,
over at most ``TRAIN_DOCS`` labelled documents chosen by a hash of their id;
features without a significant association with the label stay at zero, so long
clean texts do not collect noise.

Null and empty texts have no feature and get the score of the intercept.  With no
usable label (none, or only one class) every text gets the observed share of
toxic labels (0 without labels).  Repeated label rows count as toxic if one is.
Only doc_id and text of the documents are read; a null doc_id is never learnt from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.llm.textarrays import Words, bounded_batches, release_memory, slices, text_buffers
from aurum.llm.training import Sparse, first_by_hash, fold, list_column, one_per_id, per_batch, row_sums

BITS = 18
FACTORS = 8
PREFIXES = (4, 5)
#: Bound of the training sample.
TRAIN_DOCS = 12_000
EPOCHS = 20
RATE, DECAY = 0.2, 1e-4
PAIR_RATE, PAIR_DECAY = 0.05, 1e-3
#: Chi-square (one degree of freedom) a feature needs to take part.
ASSOCIATION = 25.0
THRESHOLD = 0.3
#: A byte of text takes about a hundred in arrays of features and factors.
SLICE_BYTES = 1 << 18

_LETTER = np.zeros(256, dtype=bool)
_LETTER[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True


def features(texts: pa.Array):
    """Yields (row offsets, sorted distinct feature numbers) for runs of texts."""
    offs, raw = text_buffers(texts)
    mask = np.uint64((1 << BITS) - 1)
    for i, j in slices(offs, SLICE_BYTES):
        w = Words(offs, raw, i, j, ink=_LETTER)
        spans = [w.hashes()]
        for k, p in enumerate(PREFIXES):
            end = np.minimum(w.start + p, w.end)
            spans.append(w.span_hash(w.start, end) + np.uint64(k + 1))
        row = np.repeat(np.arange(j - i, dtype=np.uint64), np.diff(w.first))
        keys = np.concatenate([(row << np.uint64(BITS)) | (h & mask) for h in spans])
        keys = np.unique(keys)
        at = np.searchsorted(keys, np.arange(j - i + 1, dtype=np.uint64) << np.uint64(BITS))
        yield at, (keys & mask).astype(np.int64)


class FactorizationMachine:
    """w0, w (features,) and v (features, FACTORS)."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    @classmethod
    def constant(cls, share: float) -> "FactorizationMachine":
        share = min(max(share, 1e-6), 1 - 1e-6)
        n = 1 << BITS
        return cls(float(np.log(share / (1 - share))), np.zeros(n, np.float32), np.zeros((n, FACTORS), np.float32))

    def margins(self, index: np.ndarray, at: np.ndarray) -> np.ndarray:
        v = self.v[index]
        s = row_sums(v, at)
        return self.w0 + row_sums(self.w[index], at) + 0.5 * (s * s - row_sums(v * v, at)).sum(axis=1)

    def scores(self, texts: pa.Array) -> np.ndarray:
        parts = [self.margins(index, at) for at, index in features(texts)]
        z = np.concatenate(parts) if parts else np.zeros(0)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def associated(x: Sparse, y: np.ndarray) -> np.ndarray:
    """Features whose presence and label are not independent (chi-square)."""
    n, pos = len(y), y.sum()
    with_f, both = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for lo in range(0, n, 512):                              # the sample's features at once would be large
        at = x.at[lo:min(lo + 512, n) + 1]
        part = x.index[at[0]:at[-1]]
        with_f += np.bincount(part, minlength=1 << BITS)
        both += np.bincount(part, weights=np.repeat(y[lo:lo + 512], np.diff(at)), minlength=1 << BITS)
    det = both * n - with_f * pos
    scale = with_f * (n - with_f) * pos * (n - pos)
    chi = np.divide(n * det * det, scale, out=np.zeros_like(det), where=scale > 0)
    return np.flatnonzero(chi >= ASSOCIATION)


def train(x: Sparse, y: np.ndarray, seed: int = 7) -> FactorizationMachine:
    if len(y) == 0 or y.min() == y.max():
        return FactorizationMachine.constant(float(y.mean()) if len(y) else 0.0)
    used = associated(x, y)
    place, known = np.full(1 << BITS, -1), np.zeros(1 << BITS, bool)
    place[used], known[used] = np.arange(len(used)), True
    keep = known[x.index]
    at = np.concatenate(([0], np.cumsum(keep, dtype=np.int32)))[x.at].astype(np.int64)
    x = Sparse(place[x.index[keep]], x.value[keep], at)

    rng = np.random.default_rng(seed)
    m = len(used)
    w0, w, v = np.log(y.mean() / (1 - y.mean())), np.zeros(m), rng.normal(0, 0.01, (m, FACTORS))
    g0, gw, gv = 1e-8, np.full(m, 1e-8), np.full((m, FACTORS), 1e-8)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), 128):
            which = order[lo:lo + 128]
            b = x.rows(which)
            row, vi = b.row_of(), v[b.index]
            s = row_sums(vi, b.at)
            z = w0 + row_sums(w[b.index], b.at) + 0.5 * (s * s - row_sums(vi * vi, b.at)).sum(axis=1)
            err = 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - y[which]
            e = err[row]
            touched, back = np.unique(b.index, return_inverse=True)
            dw = np.bincount(back, weights=e, minlength=len(touched)) + DECAY * w[touched]
            dv = np.zeros((len(touched), FACTORS))
            np.add.at(dv, back, e[:, None] * (s[row] - vi))
            dv += PAIR_DECAY * v[touched]
            d0 = err.sum()
            g0 += d0 * d0
            w0 -= RATE * d0 / np.sqrt(g0)
            gw[touched] += dw * dw
            w[touched] -= RATE * dw / np.sqrt(gw[touched])
            gv[touched] += dv * dv
            v[touched] -= PAIR_RATE * dv / np.sqrt(gv[touched])
    full = FactorizationMachine.constant(0.5)
    full.w0 = float(w0)
    full.w[used], full.v[used] = w, v
    return full


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the training fold: crc32 of the id modulo 4 is not 2."""
    return (labels.filter(F.col("toxic").isNotNull() & (fold("doc_id", 4) != 2))
                  .groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic")))


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> FactorizationMachine:
    """Trains on at most ``limit`` labelled documents; features are made on the executors."""
    ids = first_by_hash(labelled(labels), limit)
    sample = one_per_id(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"), "toxic")     # at most ``limit`` rows

    def lists(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [index[a:b] for at, index in features(batch.column("text")) for a, b in zip(at[:-1], at[1:])]
        return pa.record_batch([batch.column("doc_id"), batch.column("toxic"), list_column(rows, pa.int32())],
                               names=["doc_id", "toxic", "features"])

    made = sample.mapInArrow(per_batch(lists), "doc_id bigint, toxic double, features array<int>").toArrow()
    made = made.sort_by([("doc_id", "ascending")])
    lists, y = made.column("features").combine_chunks(), made.column("toxic").to_numpy()
    index = lists.values.to_numpy()
    x = Sparse(index, np.broadcast_to(1.0, len(index)), lists.offsets.to_numpy().astype(np.int64))
    del made
    return train(x, y)


def with_score(spark: SparkSession, docs: DataFrame, model: FactorizationMachine, name: str = "score") -> DataFrame:
    """``docs`` with one more column, the probability that the text is toxic."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)          # a fixed size, whatever the corpus

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        out = pa.array(shared.value.scores(text))
        release_memory()
        return out

    return docs.withColumn(name, score(F.col("text")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    spark = docs.sparkSession
    out = with_score(spark, docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    score = "_score"
    while score in docs.columns:
        score = "_" + score
    out = with_score(docs.sparkSession, docs, fit(docs, labels), score)
    return out.filter(F.col(score) < THRESHOLD).select(*docs.columns)
