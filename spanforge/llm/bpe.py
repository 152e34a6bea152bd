"""Byte-level BPE encoding and decoding by monoid tree reduction (operator 3).

A text is halved down to leaves; a leaf is encoded on its own; neighbours are
joined by encoding a window around their border again.  The window grows until
the tokens outside it provably stand:

* Text level.  Each match of the split pattern is encoded separately.  A match
  that holds a visible character never goes on into white space, and the pattern
  looks behind nothing and ahead one character only over white space.  So between
  a visible character and a blank a match ends whatever surrounds it.  The window
  grows to both sides up to such a place (or the half's end).
* Inside one match (a very long word or run).  Merges are done in the order
  (rank, position).  A first merge across the border of two tokens would also
  happen when the two are encoded alone, as merges elsewhere keep their order.
  So a row of tokens is the encoding of its bytes if every neighbouring pair
  encodes to itself.  Joining takes k tokens on each side, encodes their bytes
  again and doubles k until the pairs at both edges of the window encode to
  themselves.

Decoding is the concatenation of token bytes, again up a tree.

Spark splits the work by document; the tree keeps a single huge text or word from
costing more than n log n.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructField, StructType

from .scratch import map_batches

#: characters of a leaf of the text, bytes of a leaf inside one match
LEAF, MATCH_LEAF = 4096, 4096
#: between these two characters a match always ends: a visible one that is no
#: white space in any reading, and a blank
_BORDER = re.compile("(?<=[!-~À-ɏ])(?=[ \n])")


class TreeBpe:
    """Encoder and decoder for one rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.ranks = ranks
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        import regex
        self.matches = regex.compile(pattern)
        self.pair = functools.lru_cache(1 << 16)(self._pair)

    # inside one match -------------------------------------------------------
    def _merge(self, piece: bytes) -> list[int]:
        """Merges of a byte string, lowest rank first, leftmost first."""
        n, get = len(piece), self.ranks.get
        end = list(range(1, n + 1))          # part i is piece[i:end[i]]; 0: merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if j == 0 or j >= n or end[j] != stop:
                continue                     # one of the two has changed since
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if i and (r := get(piece[before[i]:stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i:end[i]]])
            i = end[i]
        return ids

    def _pair(self, a: int, b: int) -> bool:
        return self._merge(self.bytes[a] + self.bytes[b]) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the two sides' bytes within one match."""
        if not left or not right:
            return left + right
        if self.pair(left[-1], right[0]):
            return left + right
        k = 1
        while True:
            i, j = max(0, len(left) - k), min(len(right), k)
            middle = self._merge(b"".join([self.bytes[t] for t in left[i:] + right[:j]]))
            if ((i == 0 or self.pair(left[i - 1], middle[0]))
                    and (j == len(right) or self.pair(middle[-1], right[j]))):
                return left[:i] + middle + right[j:]
            k *= 2

    def _row(self, piece: bytes) -> list[int]:
        if len(piece) <= MATCH_LEAF:
            return self._merge(piece)
        half = len(piece) // 2
        return self.join(self._row(piece[:half]), self._row(piece[half:]))

    def match(self, piece: str) -> list[int]:
        """One match of the pattern; a match that is a token is that token."""
        data = piece.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        return self._row(data)

    # text level ---------------------------------------------------------------
    def leaf(self, text: str) -> np.ndarray:
        if len(text) <= 2 * LEAF:
            return self.encoding.encode_to_numpy(text, disallowed_special=()).astype(np.int32, copy=False)
        ids: list[int] = []                  # a window that had to grow far: a very long run
        for m in self.matches.finditer(text):
            ids += self.match(m.group())
        return np.array(ids, dtype=np.int32)

    def _window(self, text: str, lo: int, mid: int, hi: int) -> tuple[int, int]:
        """Border places p <= mid <= q around mid, within [lo, hi]."""
        size = 32
        while True:
            p, q = max(lo, mid - size), min(hi, mid + size)
            left = [m.start() for m in _BORDER.finditer(text, p, mid + 1) if p < m.start() <= mid]
            right = _BORDER.search(text, mid + 1, q)
            at_p = left[-1] if left else (lo if p == lo else None)
            at_q = right.start() if right else (hi if q == hi else None)
            if at_p is not None and at_q is not None:
                return at_p, at_q
            size *= 2

    def _cut(self, ids: np.ndarray, n_bytes: int, head: bool) -> int:
        """How many tokens at one end make up ``n_bytes``."""
        k = 0
        while n_bytes > 0:
            n_bytes -= len(self.bytes[ids[k] if head else ids[-1 - k]])
            k += 1
        return k

    def encode(self, text: str, lo: int = 0, hi: int | None = None) -> np.ndarray:
        hi = len(text) if hi is None else hi
        if hi - lo <= LEAF:
            return self.leaf(text[lo:hi])
        mid = (lo + hi) // 2
        p, q = self._window(text, lo, mid, hi)
        if (p, q) == (lo, hi):               # one run without a border: the tree inside the match
            return self.leaf(text[lo:hi])
        left, right = self.encode(text, lo, mid), self.encode(text, mid, hi)
        cut_l = self._cut(left, len(text[p:mid].encode()), head=False)
        cut_r = self._cut(right, len(text[mid:q].encode()), head=True)
        return np.concatenate((left[:len(left) - cut_l], self.leaf(text[p:q]), right[cut_r:]))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 1 << 14:
            return b"".join(map(self.bytes.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@functools.lru_cache(2)
def tree_bpe(path: str, pattern: str) -> TreeBpe:
    """One encoder for each Python worker."""
    return TreeBpe(path, pattern)


def _with(df: DataFrame, name: str, kind: DataType) -> StructType:
    return StructType([*df.schema.fields, StructField(name, kind)])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids`` (array of int) appended, a row per row.

    A null or empty text has no ids; texts of any length are encoded whole;
    repeated rows repeat; other columns pass through, but an own column ``ids`` is
    replaced; an empty table stays empty.
    """
    docs = docs.drop("ids")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tree_bpe(path, pattern)
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                ids = [bpe.encode(t.as_py() or "") for t in part.column(at)]
                ends = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "ids"])

    return map_batches(docs, run, _with(docs, "ids", ArrayType(IntegerType())))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """A frame with ``ids`` -> the same with ``bytes`` (binary) appended; null ids: empty."""
    encoded = encoded.drop("bytes")
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tree_bpe(path, pattern)
        for b in batches:
            out = [bpe.decode(t.values.to_pylist() if t.is_valid else []) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "bytes"])

    return map_batches(encoded, run, _with(encoded, "bytes", BinaryType()))
