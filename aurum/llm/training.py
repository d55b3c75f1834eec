"""What the trained operators share: held-out folds, bounded samples, sparse rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % F.lit(mod)


def first_by_hash(rows: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """At most ``n`` rows, the same on every run: the smallest by a hash of the key.

    Rows far above the nth hash are filtered out where they are read, so the one
    task that picks the last ones gets about ``n`` rows however many there are."""
    total = rows.count()
    if total > 2 * n:
        span = 1 << 31
        rows = rows.filter(F.pmod(F.xxhash64(key), F.lit(span)) < int(span * 1.25 * n / total))
    return rows.orderBy(F.pmod(F.xxhash64(key), F.lit(1 << 31)), key).limit(n)


def one_per_id(rows: DataFrame, label: str) -> DataFrame:
    """(doc_id, ``label``, text): one row per (doc_id, ``label``), the smallest by a hash of its text."""
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")
    return rows.groupBy("doc_id", label).agg(first).select("doc_id", label, F.col("first.text").alias("text"))


class Sparse:
    """Rows of (index, value) pairs in flat arrays; ``at`` has rows + 1 offsets."""

    def __init__(self, index: np.ndarray, value: np.ndarray, at: np.ndarray):
        self.index, self.value, self.at = index, value, at

    @classmethod
    def of_lists(cls, index: list, value: list | None = None) -> "Sparse":
        at = np.concatenate(([0], np.cumsum([len(x) for x in index]))).astype(np.int64)
        flat = np.concatenate([np.asarray(x, np.int64) for x in index]) if index else np.zeros(0, np.int64)
        val = (np.ones(len(flat)) if value is None
               else np.concatenate([np.asarray(x, np.float64) for x in value]) if value else np.zeros(0))
        return cls(flat, val, at)

    def __len__(self) -> int:
        return len(self.at) - 1

    def rows(self, which: np.ndarray) -> "Sparse":
        size = self.at[which + 1] - self.at[which]
        at = np.concatenate(([0], np.cumsum(size)))
        take = np.repeat(self.at[which] - at[:-1], size) + np.arange(at[-1])
        return Sparse(self.index[take], self.value[take], at)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.at))


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows [at[i], at[i + 1]); empty rows give 0."""
    out = np.zeros((len(at) - 1, *values.shape[1:]))
    full = np.flatnonzero(at[1:] > at[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, at[full], axis=0, dtype=np.float64)
    return out


def list_column(lists: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offs = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
    flat = np.concatenate(lists) if lists else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat, kind))


def per_batch(make) -> "callable":
    """mapInArrow body from a function on one record batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield make(batch)
    return run
