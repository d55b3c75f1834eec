"""Shingle sets of whole texts as sorted arrays of 64-bit hashes.

A document's set holds its distinct runs of ``width`` consecutive words; with
fewer words the whole sequence is its one shingle; without words it is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from aurum.llm.textarrays import Words, mix64, slices, text_buffers

WIDTH = 5
_U = np.uint64
_STEP = _U(0xA0761D6478BD642F)


def shingle_sets(texts: pa.Array, width: int = WIDTH):
    """Yields one sorted ``uint64`` array of distinct shingle hashes per text."""
    offs, raw = text_buffers(texts)
    for i, j in slices(offs):
        w = Words(offs, raw, i, j)
        h = w.hashes()
        runs = np.zeros(0, np.uint64)
        if len(h) >= width:
            m = len(h) - width + 1
            runs = h[:m].copy()
            for k in range(1, width):
                runs = runs * _STEP + h[k:k + m]
            runs = mix64(runs)
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
            n = b - a
            if n >= width:
                yield np.unique(runs[a:b - width + 1])
            elif n:
                x = np.zeros(1, np.uint64)
                for k in range(a, b):
                    x = x * _STEP + h[k:k + 1]
                yield mix64(x + _U(n))              # the length keeps it apart from full runs
            else:
                yield np.zeros(0, np.uint64)
