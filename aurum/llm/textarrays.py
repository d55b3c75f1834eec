"""Vectorised word hashing over Arrow string columns.

Helpers for the operators that look at words (n-gram join, toxicity).  A
column of texts is one flat byte buffer plus offsets; words are found and
hashed with array operations over bounded slices of that buffer, so the
memory of a task does not depend on the size of a batch (a single text is
never cut: one very long text is one slice).

A word is a maximal run of bytes other than space and ``\\x09-\\x0D``; A-Z are
lower-cased, every other byte is taken as it is (UTF-8 continuation bytes are
never white space, so byte runs and character runs are the same words).
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows that Spark hands to Python at a time.
BATCH_ROWS = 1000
#: A byte of text takes about sixty in arrays of words and hashes.
SLICE_BYTES = 1 << 18


def bounded_batches(spark: SparkSession) -> None:
    """Whole texts are long: Arrow batches of this session hold at most BATCH_ROWS rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


@functools.cache
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):          # not the GNU C library
        return lambda _: 0


def release_memory() -> None:
    """Gives freed array memory back to the system; workers outlive their tasks, and what
    they keep would count against the next stage."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over all 64 output bits."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x7FB5D329728EA185)
    x = x ^ (x >> _U(27))
    x = x * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
for _c in range(ord("A"), ord("Z") + 1):
    _BYTE_CODE[_c] = _BYTE_CODE[_c + 32]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_pow = {"f": _powers(_BASE, 1 << 16), "i": _powers(_BASE_INV, 1 << 16)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow["f"]) < n:
        size = 1 << int(n - 1).bit_length()
        if size > 4 * SLICE_BYTES:            # one giant text: not kept
            return _powers(_BASE, n), _powers(_BASE_INV, n)
        _pow["f"], _pow["i"] = _powers(_BASE, size), _powers(_BASE_INV, size)
    return _pow["f"], _pow["i"]


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null text has length 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offs = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offs.astype(np.int64), raw


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each (at least one row)."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


class Words:
    """Words of rows [i, j): ``start``/``end`` byte positions in ``data`` and the
    first word of every row in ``first`` (length rows + 1).  ``ink`` says which
    bytes make words (default: all but white space)."""

    def __init__(self, offs: np.ndarray, raw: np.ndarray, i: int, j: int, ink: np.ndarray | None = None):
        lo, hi = int(offs[i]), int(offs[j])
        self.data = raw[lo:hi]
        self.rows = offs[i:j + 1] - lo
        ink = ~_IS_SPACE[self.data] if ink is None else ink[self.data]
        n = len(ink)
        begins = ink.copy()
        ends = ink.copy()
        if n:
            cut = np.zeros(n + 1, dtype=bool)      # a row's first byte starts a new word
            cut[self.rows] = True
            begins[1:] &= ~ink[:-1] | cut[1:n]
            ends[:-1] &= ~ink[1:] | cut[1:n]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.rows, side="left")
        self._sums: np.ndarray | None = None

    def _prefix(self) -> np.ndarray:
        if self._sums is None:
            n = len(self.data)
            fwd, self._inv = _power_tables(n + 1)
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_BYTE_CODE[self.data] * fwd[:n], out=sums[1:])
            self._sums = sums
        return self._sums

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans (A-Z folded), equal for equal spans."""
        s = self._prefix()
        h = (s[end] - s[start]) * self._inv[start]
        return mix64(h + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.start, self.end)
