"""Token-id files coded by a static range asymmetric numeral system (operator 8).

One frequency table, counted over all ids of the corpus, is shared by all blocks
and scaled to 2^BITS.  A block codes its ids on LANES interleaved 64-bit states
that share one stream of 32-bit words; all lanes step together, so a block is
coded and decoded by array operations.  Every CHECK steps a checkpoint stores the
states and the place in the stream: a reader may start at each, and this one
decodes all stretches of a block at once.  A block carries the crc32 of its ids,
checked on reading.

Files: a folder with two Parquet tables, written and read by Spark only.
``model``: one row per symbol (symbol, frequency).  ``blocks``: part, first (ids of the
part before the block), documents (doc_id, length), n_ids, words, checkpoints,
crc32.  Parts are ranges of doc_id in ascending order; a block holds whole documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .chunks import chunk_encoder
from .scratch import map_batches, scratch_path
from .wordarrays import buffer_of, byte_slices, string_column

BITS, LANES, CHECK, BLOCK = 20, 512, 128, 1 << 18
_LOW = 1 << 31
_SLICE = 4 << 20
U64 = np.uint64


# the coder ------------------------------------------------------------------
def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to 2^BITS, at least 1 for each symbol that occurs."""
    seen = np.flatnonzero(counts)
    freq = np.zeros(len(counts), dtype=np.int64)
    if not len(seen):
        return freq
    if len(seen) > 1 << BITS:
        raise ValueError("more symbols than places in the table")
    share = counts[seen].astype(np.float64) * ((1 << BITS) / float(counts[seen].sum()))
    part = np.maximum(1, np.floor(share).astype(np.int64))
    left = (1 << BITS) - int(part.sum())
    order = seen_order = np.argsort(-share, kind="stable")
    if left > 0:
        part[order[0]] += left
    while left < 0:                               # take from the large ones
        for i in seen_order:
            take = min(int(part[i]) - 1, max(1, int(part[i]) // 4), -left)
            part[i] -= take
            left += take
            if left == 0:
                break
    freq[seen] = part
    return freq


class Model:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(U64)
        self.base = (np.cumsum(freq) - freq).astype(U64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(words, checkpoints) of a block."""
        n = len(ids)
        steps = -(-n // LANES)
        x = np.full(LANES, _LOW, dtype=U64)
        words, used, marks = [], 0, []
        for t in range(steps - 1, -1, -1):
            s = ids[t * LANES:(t + 1) * LANES]
            f, y = self.freq[s], x[:len(s)]
            over = y >= (f << U64(63 - BITS))
            out = y[over]
            words.append(out.astype(np.uint32))
            used += len(out)
            y[over] = out >> U64(32)
            q, r = np.divmod(y, f)
            x[:len(s)] = (q << U64(BITS)) + r + self.base[s]
            if t % CHECK == 0:
                marks.append((used, x.copy()))
        words.reverse()
        stream = np.concatenate(words) if words else np.zeros(0, np.uint32)
        marks.reverse()
        heads = b"".join([np.array([used - u], dtype="<u8").tobytes() + st.astype("<u8").tobytes() for u, st in marks])
        return stream.astype("<u4").tobytes(), heads

    def decode(self, n: int, stream: bytes, heads: bytes) -> np.ndarray:
        """The ids of a block; its stretches between checkpoints step together."""
        if not n:
            return np.zeros(0, dtype=np.uint32)
        words = np.concatenate((np.frombuffer(stream, dtype="<u4"), np.zeros(1, np.uint32)))
        table = np.frombuffer(heads, dtype="<u8").reshape(-1, LANES + 1)
        at, x = table[:, 0].astype(np.int64), table[:, 1:].astype(U64)
        stretches = len(table)
        out = np.zeros((stretches, CHECK, LANES), dtype=np.uint32)
        first = np.arange(stretches)[:, None] * (CHECK * LANES) + np.arange(LANES)[None, :]
        mask = U64((1 << BITS) - 1)
        for t in range(CHECK):
            live = first + t * LANES < n
            if not live[0, 0]:
                break
            slot = x & mask
            s = self.symbol[slot.astype(np.int64)]
            out[:, t] = s
            y = self.freq[s] * (x >> U64(BITS)) + slot - self.base[s]
            need = live & (y < U64(_LOW))
            place = at[:, None] + np.cumsum(need, axis=1) - 1
            word = words[np.where(need, place, len(words) - 1)].astype(U64)
            y = np.where(need, (y << U64(32)) | word, y)
            x = np.where(live, y, x)
            at = at + need.sum(axis=1)
        return out.reshape(-1)[:n]


# Spark --------------------------------------------------------------------------
def id_width(tokenizer: str) -> int:
    """Bytes that hold any id of the vocabulary."""
    return 2 if chunk_encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else 4


def tokenise(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """``(doc_id, ids)`` per row, ids as little-endian bytes of ``id_width`` with the end
    id, and one row of (symbol, count) pairs per task in ``counts``."""
    docs = docs.select("doc_id", "text")
    width = id_width(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer)
        counts, doc_type = np.zeros(1 << 16, dtype=np.int64), None
        pair = pa.list_(pa.struct([("symbol", pa.int64()), ("n", pa.int64())]))
        for b in batches:
            doc_type = b.column(0).type
            data, off = buffer_of(string_column(b.column(1)))
            for lo, hi in byte_slices(off, _SLICE):
                ids, at = encoder.encode(data, off, lo, hi)
                ids = np.insert(ids, at[1:], end_id).astype("<u4")
                at = at + np.arange(len(at))
                here = np.bincount(ids, minlength=len(counts))
                if len(here) > len(counts):
                    counts = np.concatenate((counts, np.zeros(len(here) - len(counts), np.int64)))
                counts += here
                values = pa.Array.from_buffers(pa.binary(), hi - lo, [
                    None, pa.py_buffer((at * width).astype(np.int32)), pa.py_buffer(ids.astype(f"<u{width}"))])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), values, pa.nulls(hi - lo, pair)], names=["doc_id", "ids", "counts"])
        if doc_type is not None:
            seen = np.flatnonzero(counts).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, doc_type), pa.nulls(1, pa.binary()),
                 pa.array([[{"symbol": s, "n": int(counts[s])} for s in seen]], pair)], names=["doc_id", "ids", "counts"])

    return map_batches(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, "
                                "counts array<struct<symbol:long,n:long>>")


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0) -> None:
    """Write the ids of ``(doc_id, text)`` rows, each closed by ``end_id``, below ``path``.

    A null or empty text is the end id alone; a text of any length is one run of a
    block; rows that repeat a doc_id follow each other, ordered by their ids; null
    doc_ids come first; other columns are ignored; an empty table writes no block.
    The frequency table (one row per symbol of the vocabulary at most) is the only
    thing that reaches the driver.
    """
    spark = docs.sparkSession
    tokens = materialise_compact(tokenise(docs, tokenizer, end_id))
    histogram = (tokens.filter("counts is not null").select(F.inline("counts"))
                 .groupBy("symbol").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(max((r.symbol for r in histogram), default=0) + 1, dtype=np.int64)
    for r in histogram:
        counts[r.symbol] = r.n
    freq = scaled(counts)
    spark.createDataFrame([(int(s), int(freq[s])) for s in np.flatnonzero(freq)], "symbol long, frequency long") \
        .coalesce(1).write.parquet(f"{path}/model")
    shared = spark.sparkContext.broadcast(freq)   # bounded by the vocabulary

    ordered = (tokens.filter("ids is not null").select("doc_id", "ids")
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("ids")))
    doc_type, width = docs.schema["doc_id"].dataType.simpleString(), id_width(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        model, part = Model(shared.value), TaskContext.get().partitionId()
        held, ids, size, first = [], [], 0, 0

        def block() -> pa.RecordBatch:
            row = np.concatenate(ids)
            words, heads = model.encode(row)
            return pa.RecordBatch.from_pylist([{
                "part": part, "first": first, "documents": held, "n_ids": size, "words": words,
                "checkpoints": heads, "crc32": zlib.crc32(row.astype("<u4").tobytes())}], schema=schema)

        schema = None
        for b in batches:
            if schema is None:
                schema = pa.schema([
                    ("part", pa.int64()), ("first", pa.int64()),
                    ("documents", pa.list_(pa.struct([("doc_id", b.column(0).type), ("n", pa.int64())]))),
                    ("n_ids", pa.int64()), ("words", pa.binary()), ("checkpoints", pa.binary()), ("crc32", pa.int64())])
            for doc, value in zip(b.column(0).to_pylist(), b.column(1)):
                row = np.frombuffer(value.as_buffer(), dtype=f"<u{width}")
                if size and size + len(row) > BLOCK:
                    yield block()
                    held, ids, size, first = [], [], 0, first + size
                held.append({"doc_id": doc, "n": len(row)})
                ids.append(row)
                size += len(row)
        if size:
            yield block()

    (map_batches(ordered, run, f"part long, first long, documents array<struct<doc_id:{doc_type},n:long>>, "
                             "n_ids long, words binary, checkpoints binary, crc32 long")
     .write.option("compression", "none").parquet(f"{path}/blocks"))


def materialise_compact(df: DataFrame) -> DataFrame:
    """As ``scratch.materialise``, with a denser codec for token ids."""
    spark = df.sparkSession
    path = scratch_path(spark, "tokens")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` per document, start being the number of ids
    of all documents before it, ids as little-endian uint32 bytes.  A block whose
    ids don't have its crc32 fails the job."""
    model = spark.read.schema("symbol long, frequency long").parquet(f"{path}/model").collect()
    freq = np.zeros(max((r.symbol for r in model), default=0) + 1, dtype=np.int64)
    for r in model:
        freq[r.symbol] = r.frequency
    shared = spark.sparkContext.broadcast(freq)
    blocks = spark.read.parquet(f"{path}/blocks")
    doc_type = blocks.schema["documents"].dataType.elementType["doc_id"].dataType.simpleString()
    # a row per part: as many as the writer had partitions
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    blocks = blocks.select("part", "first", "documents", "n_ids", "words", "checkpoints", "crc32")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Model(shared.value)
        for b in batches:
            for r in range(b.num_rows):
                n = b.column(3)[r].as_py()
                ids = coder.decode(n, b.column(4)[r].as_buffer(), b.column(5)[r].as_buffer())
                if zlib.crc32(ids.astype("<u4").tobytes()) != b.column(6)[r].as_py():
                    raise ValueError(f"checksum of part {b.column(0)[r]}, from id {b.column(1)[r]}")
                held = b.column(2)[r].values
                sizes = np.asarray(held.field("n"), dtype=np.int64)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sizes), b.column(0)[r].as_py())), held.field("doc_id"),
                     pa.array(ends - sizes + b.column(1)[r].as_py()), pa.array(sizes),
                     pa.Array.from_buffers(pa.binary(), len(sizes), [
                         None, pa.py_buffer((np.concatenate(([0], ends)) * 4).astype(np.int32)),
                         pa.py_buffer(ids.astype("<u4"))])],
                    names=["part", "doc_id", "at", "n_tokens", "ids"])

    rows = map_batches(blocks, run, f"part long, doc_id {doc_type}, at long, n_tokens long, ids binary")
    return rows.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids")
