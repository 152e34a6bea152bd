"""Vectors and similarity.

Pairs always come from a given pair list or an equi-join key — never a cross
join.  Vector math of a row stays in array expressions (JVM); mean vectors are
summed by group of keys, so that a vector travels once a group."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.session import write_scratch


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either norm is 0."""
    na, nb = norm(a), norm(b)
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot(a, b) / (na * nb))


def lookup_vectors(rows: DataFrame, vectors: DataFrame, key: str, vec_key: str, vec_col: str) -> DataFrame:
    """Attach a vector to each row by key; the optimizer broadcasts the table if its
    byte statistics allow, else a hot key's partition can be split."""
    return rows.join(vectors.select(F.col(vec_key).alias(key), vec_col), key, "left")


def cosine_pairs(pairs: DataFrame, vectors: DataFrame, a: str, b: str, vec_key: str, vec_col: str) -> DataFrame:
    """I2 over a pair list: two equi-joins, then the row-local cosine."""
    va = vectors.select(F.col(vec_key).alias(a), F.col(vec_col).alias("__va"))
    vb = vectors.select(F.col(vec_key).alias(b), F.col(vec_col).alias("__vb"))
    j = pairs.join(va, a).join(vb, b)
    return j.withColumn("cosine", cosine(F.col("__va"), F.col("__vb"))).drop("__va", "__vb")


def mean_vector(rows: DataFrame, key: list[str], vec_key: str, vectors: DataFrame, vec_col: str,
                block: int = 64, rows_at_once: int = 1 << 24, bytes_at_once: int = 1 << 28) -> DataFrame:
    """Mean of the row vectors per key (n_vectors, mean_vec), of any dimension.

    Occurrences are counted per (key, vector) batch by batch, packed to some two bytes
    each and written.  Keys are dealt by hash into groups; a group gets each vector that
    it asks for once, whatever the number of its keys, and sums them in place, ``block``
    elements at a time.  So the counts are shuffled once, packed, no vector travels for
    each key, and no sums are shuffled.  A group has about ``rows_at_once`` counts, and
    some ``bytes_at_once`` of sums and of vectors, at most: the larger the groups, the
    fewer times a vector travels.
    Where vectors differ in length, an element's mean is over all ``n_vectors`` with the
    missing ones as zero.  Null vectors don't count; empty ones count, without
    elements.  A null element makes no contribution."""
    told = rows.select(*key, vec_key).where(F.col(vec_key).isNotNull())
    kinds = {f.name: f.dataType.simpleString() for f in told.schema.fields}
    whole = kinds[vec_key] in ("tinyint", "smallint", "int", "bigint")
    keys = [f"`{k}` {kinds[k]}" for k in key]
    pack, ids_of, counts_of, numbered = _packing(key, vec_key)
    counted = write_scratch(told.mapInArrow(pack, ", ".join(
        [*keys, "__n long", f"__ids {'binary' if whole else f'array<{kinds[vec_key]}>'}", "__counts binary"])), "counted", "zstd")
    dims, size = vectors.agg(F.max(F.size(vec_col)), F.sum(F.size(vec_col).cast("long")) * 8).first()
    n, pairs = counted.agg(F.count("*"), F.sum("__n")).first()
    dims, size, pairs = max(dims or 0, 1), size or 0, pairs or 0
    groups = max(1, math.ceil(pairs / rows_at_once), math.ceil(n * dims * 8 / bytes_at_once),
                 math.ceil(pairs * dims * 8 / bytes_at_once) if size > bytes_at_once else 0,
                 min(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(pairs / (1 << 20))))
    counted = counted.withColumn("__g", F.pmod(F.xxhash64(*key), F.lit(groups)).cast("int"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = ids_of(batch["__ids"], batch["__n"].to_numpy())
            pair = pa.table({"__g": pa.array(np.repeat(batch["__g"].to_numpy(), batch["__n"].to_numpy())), vec_key: ids})
            yield from pair.group_by(["__g", vec_key]).aggregate([]).select(["__g", vec_key]).cast(
                pa.schema([("__g", pa.int32()), (vec_key, ids.type)])).to_batches()
    asked = counted.select("__g", "__n", "__ids").mapInArrow(ask, f"__g int, `{vec_key}` {'long' if whole else kinds[vec_key]}").distinct()
    v = lookup_vectors(asked, vectors, vec_key, vec_key, vec_col).where(F.col(vec_col).isNotNull())
    zero = F.lit(0).cast(vectors.schema[vec_col].dataType.elementType)
    v = v.select(F.col("__g").alias("__vg"), F.col(vec_key).alias("__id"),
                 F.transform(vec_col, lambda x: F.coalesce(x, zero)).alias("__v"))
    means = _means(key, block, ids_of, counts_of, numbered)
    return counted.groupBy("__g").cogroup(v.groupBy("__vg")).applyInArrow(
        means, ", ".join([*keys, "n_vectors long", "mean_vec array<double>"]))


def _packing(key: list[str], vec_key: str) -> tuple[Callable, Callable, Callable, Callable]:
    """Counts of (key, vector id) as a row a key: the ids in order, as differences in
    bytes of seven bits, and the counts in the same way; ids that are no integers stay a
    list.  Functions that workers get whole, as they need not have this module."""
    def numbered(table: pa.Table) -> np.ndarray:
        """The keys as numbers, null among them."""
        number = np.zeros(len(table), np.int64)
        for name in key:
            told = table[name].combine_chunks() if isinstance(table[name], pa.ChunkedArray) else table[name]
            told = told.dictionary_encode(null_encoding="encode")
            for part in (told.chunks if isinstance(told, pa.ChunkedArray) else [told]):
                number = number * max(1, len(part.dictionary)) + part.indices.to_numpy(zero_copy_only=False)
                number = np.unique(number, return_inverse=True)[1].reshape(-1)
        return number

    def packed(values: np.ndarray, starts: np.ndarray) -> pa.Array:
        """Stretches of numbers, from each start to the next, as one binary each."""
        size = np.ones(len(values), np.int64)
        for k in range(1, 10):
            size += values >= np.uint64(1 << 7 * k)
        ends = np.cumsum(size)
        data = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
        for k in range(int(size.max(initial=0))):
            more = np.flatnonzero(size > k)
            data[ends[more] - size[more] + k] = (values[more] >> np.uint64(7 * k)) & np.uint64(127)
            data[ends[more] - size[more] + k] |= np.where(size[more] > k + 1, 128, 0).astype(np.uint8)
        offsets = np.concatenate(((ends - size)[starts], [len(data)])).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])

    def unpacked(told: pa.Array) -> np.ndarray:
        begin, end = (int(x) for x in np.frombuffer(told.buffers()[1], np.int32)[[told.offset, told.offset + len(told)]])
        data = np.frombuffer(told.buffers()[2] or b"", np.uint8)[begin:end]
        last = np.flatnonzero(data < 128)
        first = np.concatenate(([0], last[:-1] + 1)) if len(last) else last
        values = np.zeros(len(last), np.uint64)
        for k in range(int((last - first).max(initial=-1)) + 1):
            more = np.flatnonzero(last - first >= k)
            values[more] |= (data[first[more] + k] & 127).astype(np.uint64) << np.uint64(7 * k)
        return values

    def ids_of(told: pa.Array, sizes: np.ndarray) -> pa.Array:
        if not pa.types.is_binary(told.type):
            return told.flatten()
        steps = unpacked(told)                       # a row's first id is whole
        if not len(steps):
            return pa.array([], pa.int64())
        starts = np.cumsum(sizes) - sizes
        runs = np.cumsum(steps)                      # modulo 2^64, as the steps
        return pa.array((runs - np.repeat(runs[starts] - steps[starts], sizes)).view(np.int64))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            number, ids = numbered(batch), batch[vec_key]
            whole = pa.types.is_integer(ids.type)
            place = ids.to_numpy(zero_copy_only=False).astype(np.int64) if whole else ids.dictionary_encode().indices.to_numpy()
            order = np.lexsort((place, number))
            n, i = number[order], place[order]
            new_key = np.concatenate(([True], n[1:] != n[:-1]))
            pair = np.flatnonzero(new_key | np.concatenate(([True], i[1:] != i[:-1])))
            starts = np.flatnonzero(new_key[pair])
            counts = np.diff(np.concatenate((pair, [len(n)])))
            if whole:
                i = i[pair].view(np.uint64)
                steps = np.concatenate((i[:1], i[1:] - i[:-1]))
                steps[starts] = i[starts]
                told = packed(steps, starts)
            else:
                told = pa.ListArray.from_arrays(pa.array(np.concatenate((starts, [len(pair)])), pa.int32()), ids.take(pa.array(order[pair])))
            keys = pa.array(order[pair[starts]])
            yield pa.RecordBatch.from_arrays(
                [*(batch[name].take(keys) for name in key), pa.array(np.diff(np.concatenate((starts, [len(pair)])))),
                 told, packed(counts.astype(np.uint64), starts)], names=[*key, "__n", "__ids", "__counts"])

    def counts_of(told: pa.Array) -> np.ndarray:
        return unpacked(told).astype(np.int64)

    return pack, ids_of, counts_of, numbered


def _means(key: list[str], block: int, ids_of: Callable, counts_of: Callable, numbered: Callable,
           chunk: int = 1 << 15) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The means of a group's keys, of its packed counts and its vectors: a function that
    workers get whole, as they need not have this module."""
    def means(counts: pa.Table, vectors: pa.Table) -> pa.Table:
        counts, vectors = counts.combine_chunks(), vectors.combine_chunks()
        number = numbered(counts)
        by_key = np.argsort(number, kind="stable")
        counts, number = counts.take(pa.array(by_key)).combine_chunks(), number[by_key]
        lists = vectors["__v"].combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
        values = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        # a vector id may have several vectors: each counts
        ids = vectors["__id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        # packed rows one after the other, a stretch of them at a time
        size = counts["__n"].to_numpy()
        ends = np.cumsum(size)
        keys = int(number[-1]) + 1 if len(number) else 0
        total, dims = np.zeros(keys, np.int64), np.zeros(keys, np.int64)
        sums = np.zeros((keys, int(sizes.max(initial=0))))
        lo = 0
        while lo < len(size):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + chunk, "right")))
            part = counts.slice(lo, hi - lo).to_batches()
            wanted = np.concatenate([ids_of(b["__ids"], b["__n"].to_numpy()).to_numpy(zero_copy_only=False) for b in part])
            n = np.concatenate([counts_of(b["__counts"]) for b in part])
            of = np.repeat(number[lo:hi], size[lo:hi])
            lo = hi
            low, high = np.searchsorted(ids, wanted, "left"), np.searchsorted(ids, wanted, "right")
            met = high - low
            of, n = np.repeat(of, met), np.repeat(n, met)
            vec = order[np.repeat(low - (np.cumsum(met) - met), met) + np.arange(len(of))]
            for at in range(0, len(of), chunk):          # one packed row may be long
                v, t, w = vec[at:at + chunk], of[at:at + chunk], n[at:at + chunk]
                begin = np.flatnonzero(np.concatenate(([True], np.diff(t) != 0)))
                total[t[begin]] += np.add.reduceat(w, begin)
                dims[t[begin]] = np.maximum(dims[t[begin]], np.maximum.reduceat(sizes[v], begin))
                for e in range(0, sums.shape[1], block):
                    place = np.arange(e, min(e + block, sums.shape[1]))
                    if (sizes[v] >= place[-1] + 1).all():
                        got = values[begins[v][:, None] + place] * w[:, None].astype(np.float64)
                    else:
                        has = place < sizes[v][:, None]
                        got = np.where(has, values[np.where(has, begins[v][:, None] + place, 0)] if len(values) else 0.0, 0.0) * w[:, None]
                    sums[t[begin], e:e + block] += np.add.reduceat(got, begin, axis=0)
        found = np.flatnonzero(total)
        if len(found) < keys:
            total, dims, sums = total[found], dims[found], sums[found]
        sums /= total[:, None]
        inside = np.arange(sums.shape[1]) < dims[:, None]
        mean = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(dims))), pa.int32()),
                                        pa.array(sums.reshape(-1) if inside.all() else sums[inside]))
        first = pa.array(np.searchsorted(number, found))
        return pa.table([*(counts[name].take(first) for name in key), pa.array(total), mean],
                        names=[*key, "n_vectors", "mean_vec"])
    return means
