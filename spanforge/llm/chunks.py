"""Token ids of a batch of texts from a tokenizers file, each distinct stretch encoded once.

A byte-level BPE file splits a text by a pattern before it merges.  Between a
visible character and the blank behind it a match of that pattern always ends
(a match with a visible character holds no later blank, and the pattern looks
only ahead, over white space).  Texts are cut there into chunks; each distinct
chunk of a slice goes to the library once, and a worker keeps the ids of the short chunks it
met first (a bounded number; it starts anew when most chunks of a slice are unknown).  Chunks are told apart by 64-bit hashes of their bytes; where no
such place exists (other scripts, runs of blanks) a chunk simply is longer.
"""

from __future__ import annotations

import functools
import os

import numpy as np

from .wordarrays import BYTE_VALUE, mix64, powers

KEPT_CHUNKS, KEPT_BYTES = 1 << 20, 64
_BATCH = 2048                    # chunks that go to the library at a time


def _borders(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Start of every chunk; a row starts a chunk."""
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    cut[off] = True
    if n > 1:
        blank = (data[1:] == 0x20) | (data[1:] == 0x0A)
        before = data[:-1]
        seen = (before > 0x20) & (before < 0x7F)
        # two-byte letters U+00C0..U+02BF
        seen[1:] |= (before[1:] >= 0x80) & (before[1:] < 0xC0) & (data[:-2] >= 0xC3) & (data[:-2] <= 0xCA)
        cut[1:n] |= blank & seen
    return np.flatnonzero(cut[:n])


class ChunkEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self):
        self.keys = np.zeros(0, np.uint64)       # sorted chunk hashes
        self.at = np.zeros(0, np.int64)          # where their ids start in the pool
        self.count = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, count = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i in range(0, len(texts), _BATCH):       # an encoding is far larger than its ids
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts[i:i + _BATCH], add_special_tokens=False)]
            count.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter((i for x in found for i in x), np.uint32, int(count[-1].sum())))
        return np.concatenate(ids), np.concatenate(count)

    def encode(self, data: np.ndarray, off: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the rows [a, b) in a row, offsets per row)."""
        lo, hi = int(off[a]), int(off[b])
        data, rows = data[lo:hi], off[a:b + 1] - lo
        n = hi - lo
        if not n:
            return np.zeros(0, np.uint32), np.zeros(b - a + 1, np.int64)
        start = _borders(data, rows)
        end = np.append(start[1:], n)
        up, down = powers(0, n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUE[data] * up[:-1], dtype=np.uint64, out=sums[1:])
        key = mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
        keys, first, chunk = np.unique(key, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        if len(self.keys):
            known = self.keys[np.minimum(place, len(self.keys) - 1)] == keys
        else:
            known = np.zeros(len(keys), dtype=bool)
        new = np.flatnonzero(~known)
        raw = data.tobytes()
        s, e = start[first[new]], end[first[new]]
        ids, count = self._library([raw[i:j].decode() for i, j in zip(s.tolist(), e.tolist())])
        pool = np.concatenate((self.pool, ids))
        at, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at[known], size[known] = self.at[place[known]], self.count[place[known]]
        at[new], size[new] = len(self.pool) + np.cumsum(count) - count, count
        # all chunks in order
        size_all = size[chunk]
        ends = np.cumsum(size_all)
        take = np.repeat(at[chunk] - (ends - size_all), size_all) + np.arange(int(ends[-1]))
        out = pool[take]
        offsets = np.concatenate(([0], ends))[np.searchsorted(start, rows)]
        keep = (e - s) <= KEPT_BYTES
        if len(self.keys) + int(keep.sum()) > KEPT_CHUNKS:
            if 2 * len(new) > len(keys):     # full, and of little use for these texts
                self._forget()
        elif keep.any():
            kept_count = count[keep]
            self_at = len(self.pool) + np.cumsum(kept_count) - kept_count
            self.pool = np.concatenate((self.pool, ids[np.repeat(keep, count)]))
            where = place[new][keep]
            self.keys = np.insert(self.keys, where, keys[new][keep])
            self.at = np.insert(self.at, where, self_at)
            self.count = np.insert(self.count, where, kept_count)
        return out, offsets


@functools.lru_cache(2)
def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder for each Python worker."""
    return ChunkEncoder(path)
