"""Vectorized words of a batch of texts: byte positions and 64-bit hashes, without a Python object per word.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; A-Z count as a-z.
The hash of a word is a polynomial over random byte values, so one running sum over a block
of texts gives the hashes of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20  # texts worked on at once; a longer text is a block of its own

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finalizer of splitmix64)."""
    x = np.asarray(x, dtype=_U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


class _Powers:
    """Powers of one base modulo 2**64, extended when a longer block needs them."""

    def __init__(self, base: int) -> None:
        self.base, self.values = _U(base), np.ones(1, dtype=_U)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            steps = np.full(max(n, 2 * len(self.values)), self.base, dtype=_U)
            steps[0] = 1
            self.values = np.multiply.accumulate(steps)
        return self.values[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_INVERSE)


def text_blocks(column: pa.Array | pa.ChunkedArray, block: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds) of runs of rows with about ``block`` bytes; null is empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(at, at[row] + block, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield row, raw[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes, first): byte ranges and hashes of all words of a block; the words of
    its row r are numbers first[r] to first[r + 1]."""
    n = len(raw)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(0, dtype=_U), np.zeros(len(bounds), dtype=np.int64)
    is_word = ~_IS_SPACE[raw]
    opens = is_word.copy()
    opens[1:] &= ~is_word[:-1]
    at = bounds[:-1][bounds[:-1] < n]
    opens[at] = is_word[at]
    closes = is_word.copy()
    closes[:-1] &= ~is_word[1:]
    last = bounds[1:][bounds[1:] > 0] - 1
    closes[last] = is_word[last]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    total = np.zeros(n + 1, dtype=_U)
    np.cumsum(_BYTE[_LOWER[raw]] * _UP.upto(n), out=total[1:])
    hashes = mix((total[ends] - total[starts]) * _DOWN.upto(n)[starts])
    return starts, ends, hashes, np.searchsorted(starts, bounds)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per row, the sorted distinct hashes of its k-word shingles; with fewer than k words the
    whole sequence is one; without words there are none."""
    n, rows = len(hashes), len(first) - 1
    rolled = np.zeros(max(0, n - k + 1), dtype=_U)
    for j in range(k):
        rolled = rolled * _U(_BASE) + hashes[j : n - k + 1 + j] if n >= k else rolled
    rolled = mix(rolled)
    for r in range(rows):
        a, b = int(first[r]), int(first[r + 1])
        if b - a >= k:
            yield np.unique(rolled[a : b - k + 1])
        elif b > a:
            h = np.array([b - a], dtype=_U)
            for j in range(a, b):
                h = mix(h) + hashes[j : j + 1]
            yield mix(h)
        else:
            yield rolled[:0]
