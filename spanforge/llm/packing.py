"""Best-fit packing into bins of several permitted sizes (operator 4).

Texts are measured in tokens; one longer than the largest size is cut into pieces of
that size and a rest.  Pieces are dealt by hash into shards of a bounded number of
pieces; within a shard they come by falling length (ties by id and piece), and each
goes into the open bin that it leaves the least room in.

If none fits, a bin is opened.  A bin of s tokens costs ``overhead`` + s + s^2 / ``span``:
every position is computed, and every position attends to the others.  For each size that
holds the piece, the bin is filled on trial from the pieces that are still to come (the
longest that fits, again and again), and the size with the least cost per token so
held is opened.  Long pieces need large bins; short ones open small ones, unless they
would leave them badly filled.  At the end every bin is downsized to the smallest
permitted size that holds its contents.  Opening the largest size alone is tried as
well, and taken for a shard where its bins, downsized, cost less.

A shard leaves a few bins badly filled whatever the corpus is, so shards of constant
size lose a constant share and memory is bounded by a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .chunks import chunk_encoder
from .scratch import map_batches, materialise
from .wordarrays import buffer_of, byte_slices, string_column

SIZES = (512, 1024, 2048, 4096, 8192)
#: what a sequence costs besides its positions, and the length at which attending to
#: all positions costs as much as computing them, in tokens
OVERHEAD, SPAN = 32, 8192
SHARD = 20_000
_SLICE = 1 << 20


def token_lengths(docs: DataFrame, tokenizer: str, end_tokens: int = 1) -> DataFrame:
    """``(doc_id, length)`` per row: tokens of the whole text and ``end_tokens``."""
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer)
        for b in batches:
            data, off = buffer_of(string_column(b.column(1)))
            for lo, hi in byte_slices(off, _SLICE):
                _, at = encoder.encode(data, off, lo, hi)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(np.diff(at) + end_tokens, pa.int64())],
                    names=["doc_id", "length"])

    return map_batches(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, length long")


def cost(size: int, overhead: int = OVERHEAD, span: int = SPAN) -> float:
    """What a bin of this size costs, full or not."""
    return overhead + size + size * size / span


class Bins:
    """Bins of one shard, for its piece lengths in falling order."""

    def __init__(self, sizes: tuple[int, ...], lengths: np.ndarray, overhead: int = OVERHEAD, span: int = SPAN,
                 largest_only: bool = False):
        self.sizes = sorted(sizes)
        self.cost = {s: cost(s, overhead, span) for s in self.sizes}
        self.openable = self.sizes[-1:] if largest_only else self.sizes
        self.rising = np.ascontiguousarray(-lengths)         # for searches: rises as lengths fall
        self.total = np.concatenate(([0], np.cumsum(lengths)))
        self.room: dict[int, list[int]] = {}
        self.rooms = 0                           # bit r: some bin has room r
        self.used: list[int] = []
        self.size: list[int] = []

    def filled(self, at: int, room: int) -> int:
        """Tokens that the pieces from number ``at`` on put into this room, the longest
        that fits first."""
        taken, n = 0, len(self.rising)
        while room > 0:
            at = max(at, int(np.searchsorted(self.rising, -room)))       # the first piece no longer than the room
            if at >= n:
                break
            end = int(np.searchsorted(self.total, self.total[at] + room, side="right")) - 1
            held = int(self.total[end] - self.total[at])
            taken, room, at = taken + held, room - held, end
        return taken

    def opened(self, number: int, length: int) -> int:
        """The size to open for piece ``number``: least cost per token it would hold."""
        return min((s for s in self.openable if s >= length),
                   key=lambda s: (self.cost[s] / (length + self.filled(number + 1, s - length)), s))

    def put(self, number: int, length: int) -> tuple[int, int]:
        """(bin, place in it) of the next piece, of at most the largest size."""
        fits = self.rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            held = self.room[room]
            bin_ = held.pop()
            if not held:
                self.rooms &= ~(1 << room)
        else:
            room, bin_ = self.opened(number, length), len(self.used)
            self.used.append(0)
            self.size.append(room)
        at = self.used[bin_]
        self.used[bin_] += length
        if room > length:
            self.room.setdefault(room - length, []).append(bin_)
            self.rooms |= 1 << (room - length)
        return bin_, at

    def downsized(self) -> np.ndarray:
        """Final size of each bin."""
        sizes = np.array(self.sizes)
        return sizes[np.searchsorted(sizes, self.used)]

    def paid(self) -> float:
        """Cost of all bins after downsizing."""
        return sum(self.cost[s] for s in self.downsized().tolist())


def best_fit(sizes: tuple[int, ...], lengths: np.ndarray, overhead: int, span: int) -> tuple[Bins, list[tuple[int, int]]]:
    """Bins of falling lengths, and (bin, place) per piece: the sizes opened by their
    cost, or the largest alone where that turns out cheaper."""
    tried = []
    for largest_only in (False, True):
        bins = Bins(sizes, lengths, overhead, span, largest_only)
        tried.append((bins, [bins.put(i, n) for i, n in enumerate(lengths.tolist())]))
    return min(tried, key=lambda t: t[0].paid())


def pack(lengths: DataFrame, sizes: tuple[int, ...] = SIZES, overhead: int = OVERHEAD, span: int = SPAN,
         shard: int = SHARD) -> DataFrame:
    """``(doc_id, length)`` -> ``(doc_id, piece, start, length, bin, capacity, place)``.

    One row per piece: tokens [start, start + length) of the document lie at ``place``
    of ``bin``, whose final size is ``capacity``.  A row without tokens (null or not
    above 0) is kept with no bin; rows that repeat a doc_id are packed each; a null
    doc_id is packed like any other; other columns are ignored; an empty table gives
    an empty result.
    """
    largest = max(sizes)
    # numbered rows: neither a repeated nor a null doc_id makes a shard larger
    rows = materialise(lengths.select("doc_id", "length", F.monotonically_increasing_id().alias("row")), "lengths")
    pieces = (F.ceil(F.col("length") / largest)).cast("long")
    total = rows.agg(F.sum(F.greatest(pieces, F.lit(1)))).first()[0] or 0
    shards = max(1, -(-int(total) // shard))
    cut = (rows.filter("length > 0")
           .select("doc_id", "row", "length", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("piece"))
           .select("doc_id", "row", "piece", (F.col("piece") * largest).alias("start"),
                   F.least(F.lit(largest), F.col("length") - F.col("piece") * largest).alias("length")))
    dealt = (cut.repartition(shards, F.xxhash64("row", "piece"))
             .sortWithinPartitions(F.desc("length"), "doc_id", "piece", "row").drop("row"))
    doc_type = lengths.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held = list(batches)                     # one shard
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        size = table["length"].to_numpy()
        bins, put = best_fit(sizes, size, overhead, span)
        number = np.array([p[0] for p in put], dtype=np.int64)
        names = number + (np.int64(TaskContext.get().partitionId()) << np.int64(32))
        out = pa.Table.from_arrays(
            [*table.columns, pa.array(names), pa.array(bins.downsized()[number].astype(np.int64)),
             pa.array([p[1] for p in put], pa.int64())],
            names=["doc_id", "piece", "start", "length", "bin", "capacity", "place"])
        yield from out.to_batches(max_chunksize=1 << 15)

    packed = map_batches(dealt, run, f"doc_id {doc_type}, piece long, start long, length long, bin long, capacity long, "
                                   "place long")
    none = F.lit(None).cast("long")
    return packed.unionByName(rows.filter("length is null or length <= 0").select(
        "doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("start"),
        F.lit(0).cast("long").alias("length"), none.alias("bin"), none.alias("capacity"), none.alias("place")))


def pack_documents(docs: DataFrame, tokenizer: str, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """``(doc_id, text)`` -> the pieces of every whole text in their bins."""
    return pack(token_lengths(docs, tokenizer), sizes)
