"""Vectorised byte and word kernels for Arrow batches. Nothing here knows about Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [i, j) with about limit bytes of text at most (a longer text comes alone), as bytes and offsets.

    Null texts come as empty ones.
    """
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64; kept for the worker's next batches."""
    if len(_powers.get(int(base), ())) < n:
        out = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        out[0] = 1
        _powers[int(base)] = np.multiply.accumulate(out)
    return _powers[int(base)][:n]


class SpanHasher:
    """Hashes of any byte spans of one buffer, by prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        terms = data.astype(np.uint64)
        terms += np.uint64(1)
        terms *= powers(_BASE, n + 1)[:n]
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=self._sums[1:])
        self._unshift = powers(_BASE_INVERSE, n + 1)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._unshift[start])

    def grams(self, q: int) -> np.ndarray:
        """Of every span of q bytes, by its start."""
        n = max(0, len(self._sums) - q)
        return mix((self._sums[q : q + n] - self._sums[:n]) * self._unshift[:n])


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without space bytes) and each word's row. No word crosses rows."""
    solid = ~SPACE[data]
    n = len(data)
    first, last = np.empty(n, bool), np.empty(n, bool)
    if n:
        first[0] = last[-1] = True
        first[1:] = ~solid[:-1]
        last[:-1] = ~solid[1:]
        inner = offs[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        first[inner] = True
        last[inner - 1] = True
    starts = np.flatnonzero(solid & first)
    ends = np.flatnonzero(solid & last) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """words(), and the hash of each word with A-Z as a-z."""
    starts, ends, rows = words(data, offs)
    return starts, ends, rows, SpanHasher(LOWER[data]).spans(starts, ends)


def shingles(word: np.ndarray, row: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of k consecutive words by row, sorted by row then hash; a row with fewer words has one, of all its words."""
    counts = np.bincount(row, minlength=n_rows)
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    out, at = [], []
    if len(word) >= k:
        inside = row[: len(word) - k + 1] == row[k - 1 :]
        h = np.zeros(len(word) - k + 1, np.uint64)
        for i in range(k):
            h = (h + word[i : len(word) - k + 1 + i]) * np.uint64(0xD6E8FEB86659FD93)
        out.append(mix(h)[inside])
        at.append(row[: len(word) - k + 1][inside])
    for r in np.flatnonzero((counts > 0) & (counts < k)):
        h = np.full(1, counts[r], np.uint64)
        for i in range(firsts[r], firsts[r] + counts[r]):
            h = (h + word[i : i + 1]) * np.uint64(0xD6E8FEB86659FD93)
        out.append(mix(h))
        at.append(np.array([r]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, r = np.concatenate(out), np.concatenate(at).astype(np.int64)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return r[fresh], h[fresh]


def sliding(values: np.ndarray, width: int, ufunc: np.ufunc, pad: int) -> np.ndarray:
    """ufunc (minimum or maximum) over every window of the given width, by window start."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = np.full(-(-len(values) // width) * width, pad, values.dtype)
    blocks[: len(values)] = values
    grid = blocks.reshape(-1, width)
    ahead = ufunc.accumulate(grid, axis=1).reshape(-1)
    back = ufunc.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return ufunc(back[:n], ahead[width - 1 : width - 1 + n])
