"""Filters over 64-bit hashes: a bounded broadcast that spares a shuffle most of its rows.

A filter never misses a key, so what it lets through is decided by an exact join
afterwards.  Its size follows the number of keys up to ``max_bytes``; with more keys it
lets more through, and results stay the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .scratch import map_batches, materialise
from .wordarrays import mix64

_HASHES = 4
_SEGMENTS = 64       # a key sets bits in one segment, which its low bits name


class Bloom:
    def __init__(self, bits: np.ndarray):
        self.bits, self.each = bits, np.uint64(len(bits) * 8 // _SEGMENTS)

    def starts(self, keys: np.ndarray) -> np.ndarray:
        """The first bit of each key's segment."""
        return (keys.view(np.uint64) & np.uint64(_SEGMENTS - 1)) * self.each

    def places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        """Bit numbers of each key, one array per hash."""
        one = mix64(keys.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        two = mix64(one) | np.uint64(1)
        start = self.starts(keys)
        for i in range(_HASHES):
            yield start + ((one + np.uint64(i) * two) & (self.each - np.uint64(1)))

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        left = np.arange(len(keys))
        one = mix64(keys.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        two, start = None, self.starts(keys)
        for i in range(_HASHES):
            at = start[left] + (one & (self.each - np.uint64(1)))
            some = np.flatnonzero((self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1))
            left, one = left[some], one[some]
            two = mix64(one) | np.uint64(1) if two is None else two[some]   # of the first hash, before steps
            one = one + two
        held = np.zeros(len(keys), dtype=bool)
        held[left] = True
        return held


def bloom(keys: DataFrame, bits_per_key: int = 12, max_bytes: int = 8 << 20) -> Bloom:
    """The filter of a one-column DataFrame of longs.  Keys are moved by segment first, so
    a cell is filled in one task, and tasks give out no more cells than the filter has,
    however many tasks there are.  What reaches the driver are the 64-bit cells that are
    set: ``max_bytes`` at most, whatever the number of keys."""
    wanted = max(1 << 13, min(8 * max_bytes, bits_per_key * keys.count()))
    size = 1 << (wanted - 1).bit_length() if wanted < 8 * max_bytes else 8 * max_bytes
    empty = Bloom(np.zeros(size // 8, np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(size // 8, np.uint8)
        for b in batches:
            for at in empty.places(b.column(0).to_numpy()):
                np.bitwise_or.at(cells, at >> np.uint64(3), (1 << (at & np.uint64(7))).astype(np.uint8))
        words = cells.view(np.int64)
        some = np.flatnonzero(words)
        for i in range(0, len(some), 1 << 16):
            part = some[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(words[part])], names=["cell", "bits"])

    key = F.col(keys.columns[0])
    dealt = keys.repartition(key.bitwiseAND(F.lit(_SEGMENTS - 1).cast("long")))
    found = map_batches(dealt, run, "cell long, bits long").toArrow()
    cells = np.zeros(size // 64, np.int64)
    # adaptive execution may split a large segment over tasks
    np.bitwise_or.at(cells, np.asarray(found["cell"]), np.asarray(found["bits"]))
    return Bloom(cells.view(np.uint8))


def cells_of(keys: DataFrame, bits_per_key: int = 32, most: int = 1 << 20) -> tuple[DataFrame, int]:
    """(``__cell``, ``__bits``) rows of a bitmap of the low bits of a one-column DataFrame
    of hashes, and the number of cells: ``most`` at most, whatever the number of keys."""
    wanted = min(most, max(64, keys.count() * bits_per_key // 64))
    size = 1 << (wanted - 1).bit_length()
    key = F.col(keys.columns[0])
    rows = (keys.select(_cell(key, size).alias("__cell"), F.expr(f"shiftleft(1L, cast(`{keys.columns[0]}` & 63 as int))").alias("bit"))
            .groupBy("__cell").agg(F.bit_or("bit").alias("__bits")))
    return materialise(rows, "cells"), size


def _cell(key: Column, size: int) -> Column:
    return F.shiftrightunsigned(key, 6).bitwiseAND(F.lit(size - 1).cast("long"))


def may_match(df: DataFrame, column: str, cells: tuple[DataFrame, int], keep: bool = True) -> DataFrame:
    """Rows whose hash ``column`` the bitmap may hold (``keep`` False: the others), by
    a join with its cells, whose number is bounded; no row goes through Python."""
    rows, size = cells
    joined = df.join(F.broadcast(rows), _cell(df[column], size) == rows["__cell"], "left")
    may = F.coalesce(F.expr(f"getbit(__bits, cast(`{column}` & 63 as int))") == 1, F.lit(False))
    return joined.filter(may if keep else ~may).drop("__cell", "__bits")


def join_few(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Left join with a right side that few rows of the left one match: only those that
    may match by their first key, a hash, are moved.  No column name may be shared."""
    cells = cells_of(right.select(on[0][1]))
    may, rest = (may_match(left, on[0][0], cells, keep) for keep in (True, False))
    same = F.lit(True)
    for l, r in on:
        same = same & (may[l] == right[r])
    return may.join(right, same, "left").union(
        rest.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]))
