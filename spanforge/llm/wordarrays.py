"""Vectorised word views of an Arrow string batch.

Words are maximal runs of bytes outside ``\\x20\\x09-\\x0D``.  No UTF-8
continuation byte lies in that set, so splitting bytes equals splitting text.
All helpers work on the UTF-8 buffer of a slice of rows at once; slices are cut
by bytes (``byte_slices``), so memory is bounded by the slice or by the longest
single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SLICE_BYTES = 1 << 20

_MULT = {0: (0x9E3779B97F4A7C15, None), 1: (0xD6E8FEB86659FD93, None), 2: (0xA0761D6478BD642F, None)}
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(m^0.., m^-0..) modulo 2^64 for one of the fixed odd multipliers."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        m = _MULT[which][0]
        size = max(n, 1 << 16)
        up = np.full(size, m, dtype=np.uint64)
        down = np.full(size, pow(m, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        have = _POWERS[which] = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return have[0][:n], have[1][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def string_column(col) -> pa.LargeStringArray:
    """Arrow string column with nulls as empty texts, one chunk."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.fill_null("").cast(pa.large_string())


def buffer_of(col: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, row offsets) without copying."""
    n = len(col)
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if n and col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, off


def byte_slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most ``limit`` bytes (one row at least)."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


class Words:
    """Words of the rows [a, b): byte ranges, row offsets and 64-bit hashes."""

    def __init__(self, data: np.ndarray, off: np.ndarray, a: int, b: int, between: np.ndarray = _SPACE):
        """``between``: for each byte value, whether it lies between words."""
        lo, hi = int(off[a]), int(off[b])
        self.data = data[lo:hi]
        self.off = off[a:b + 1] - lo
        n = hi - lo
        space = between[self.data]
        first = np.zeros(n + 1, dtype=bool)   # first byte of a row
        first[self.off] = True
        before = np.empty(n, dtype=bool)
        after = np.empty(n, dtype=bool)
        if n:
            before[0] = True
            before[1:] = space[:-1]
            before |= first[:n]
            after[-1] = True
            after[:-1] = space[1:]
            after |= first[1:]
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(~space & after) + 1
        #: row r has the words [row[r], row[r + 1])
        self.row = np.searchsorted(self.start, self.off)

    def hashes(self, value: np.ndarray | None = None) -> np.ndarray:
        """``value``: a number per byte value, if not all bytes differ."""
        up, down = powers(0, len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum((BYTE_VALUE if value is None else value)[self.data] * up[:-1], dtype=np.uint64, out=sums[1:])
        h = (sums[self.end] - sums[self.start]) * down[self.start]
        return mix64(h + (self.end - self.start).astype(np.uint64))


def window_hashes(words: np.ndarray, size: int, which: int) -> np.ndarray:
    """Hash of the ``size`` words that start at each position (len - size + 1 of
    them; a window may cross a row's end, callers mask those)."""
    n = len(words)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(which, n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix64(words ^ np.uint64(_MULT[which][0])) * up[:-1], dtype=np.uint64, out=sums[1:])
    return mix64((sums[size:] - sums[:-size]) * down[: n - size + 1])
