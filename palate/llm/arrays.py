"""Words of whole texts as numpy arrays, straight from Arrow string buffers.

A word is a maximal run of characters other than space and U+0009 to U+000D. Words, word
hashes and word n-grams of a batch of texts are computed without a Python loop over words.
Hashes are 64 bits wide and do not depend on process, batch or machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at a time (one longer text is handled alone): bounds a worker's memory.
CHUNK_BYTES = 1 << 21

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_GRAM = _U(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20240117).integers(0, 1 << 64, 256, dtype=np.uint64)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** 0 … base ** n`` modulo 2 ** 64, kept for the next batch up to the chunk size."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        have = np.full(max(n, CHUNK_BYTES) + 1, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= CHUNK_BYTES:
            _powers[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


@dataclass
class Words:
    """``data`` are the bytes of all texts; text ``i`` is ``data[text[i]:text[i + 1]]`` and has
    the words ``first[i]`` to ``first[i + 1]``; word ``w`` is ``data[start[w]:end[w]]``."""

    data: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        """Text index of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, fold: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; ``fold`` takes A-Z as a-z."""
        table = _FOLDED if fold else _BYTE
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[self.data] * _power(_BASE, n)[:n], dtype=np.uint64, out=sums[1:])
        inverse = _power(pow(_BASE, -1, 1 << 64), n)
        return mix((sums[self.end] - sums[self.start]) * inverse[self.start])


def words_of(texts: pa.Array) -> Words:
    """Words of every text of an Arrow array; a null text counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    text = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[text[0] : text[-1]] if data is not None else np.zeros(0, np.uint8)
    text = text - text[0]
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[text] = True
    left = np.ones(len(data), bool)
    left[1:] = ~inside[:-1]
    right = np.ones(len(data), bool)
    right[:-1] = ~inside[1:]
    start = np.flatnonzero(inside & (left | edge[:-1]))
    end = np.flatnonzero(inside & (right | edge[1:])) + 1
    return Words(data, text, start, end, np.searchsorted(start, text))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, by its first word; runs over the end are left out."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    acc = hashes[:m].copy()
    for j in range(1, n):
        acc *= _GRAM
        acc += hashes[j : j + m]
    return mix(acc + _U(n))


def chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about CHUNK_BYTES of text each; never cuts a text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    at = 0
    while at < len(total):
        base = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, base + CHUNK_BYTES, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column: the next ``sizes[i]`` values make row ``i``."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
