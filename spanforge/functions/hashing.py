"""Keyed, partition-independent pseudo-random draws.

``u32(seed, row, slot, salt)`` = first 32 bits of ``md5('seed|row|slot|salt')``.
A draw depends only on its key, never on partitioning or task order, so a
retried or re-planned task draws the same values (``rand(seed)`` does not).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key(*parts) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws("|", *[c.cast("string") for c in cols])


def u32(*parts) -> Column:
    """Unsigned 32-bit hash draw of the key parts (BIGINT in [0, 2^32))."""
    return F.conv(F.substring(F.md5(_key(*parts)), 1, 8), 16, 10).cast("bigint")


def draw_index(n, *parts) -> Column:
    """Uniform 0-based index in ``[0, n)``; ``n`` may be a column."""
    n = n if isinstance(n, Column) else F.lit(int(n))
    return F.pmod(u32(*parts), n.cast("bigint")).cast("int")


def unit_draw(*parts) -> Column:
    """Uniform double in ``[0, 1)``."""
    return u32(*parts) / F.lit(TWO_32)


def md5_order_key(seed, *parts) -> Column:
    """Stable shuffle key: a full md5 hex string of the seed and row key."""
    return F.md5(_key(seed, *parts))


def unit_draws(over: Column, classes: int, seed, key: Column, salt: str) -> Column:
    """``unit_draw(seed, key, p, c, salt)`` of every place ``p`` of the array ``over`` and
    every ``c < classes``, as array<array<double>>.  The hashes of a batch are computed
    together, where an expression in a lambda makes one at a time."""
    draws, tails = place_draws(), [f"{c}|{salt}" for c in range(classes)]

    def drawn(keys: pa.Array, over: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(over), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        last = np.cumsum(sizes)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(row)) - np.repeat(last - sizes, sizes)
        units = np.empty((len(row), classes))
        for c, head in enumerate(draws(keys, row, place, tails)):
            units[:, c] = head / TWO_32
        of_place = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1) * classes, pa.int32()), pa.array(units.reshape(-1)))
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], last)), pa.int32()), of_place, mask=over.is_null())

    return F.arrow_udf(drawn, "array<array<double>>")(_key(seed, key), over)


def flipped(over: Column, seed, key: Column, rate: float, n: int) -> Column:
    """The integers of the array ``over``, some replaced: place ``p`` by
    ``draw_index(n, seed, key, p, "tag")`` where ``unit_draw(seed, key, p, "flip")`` is
    below ``rate``.  The hashes of a batch are computed together."""
    draws = place_draws()

    def drawn(keys: pa.Array, over: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(over), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        last = np.cumsum(sizes)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(row)) - np.repeat(last - sizes, sizes)
        flat = over.flatten()
        flip = np.flatnonzero(draws(keys, row, place, ["flip"])[0] / TWO_32 < rate)
        told = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        told[flip] = draws(keys, row[flip], place[flip], ["tag"])[0] % n
        missing = flat.is_null().to_numpy(zero_copy_only=False)
        missing[flip] = False
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], last)), pa.int32()),
                                        pa.array(told, pa.int32(), mask=missing), mask=over.is_null())

    return F.arrow_udf(drawn, "array<int>")(_key(seed, key), over)


def place_draws() -> Callable[[pa.Array, np.ndarray, np.ndarray, list[str]], list[np.ndarray]]:
    """``u32`` of ``key|place|tail`` for places of rows, one array a tail: MD5 by vector
    operations over thousands of messages.  One too long for a block of MD5 goes the
    usual way.  A function that workers get whole, as they need not have this module."""
    adds = [int(abs(math.sin(i + 1)) * 2 ** 32) for i in range(64)]
    turns = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4

    def heads(words: list, n: int) -> np.ndarray:
        """The first 32 bits, of blocks given as 16 words: arrays, or one number for all."""
        a, b, c, d = (np.full(n, v, np.uint32) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
        f, g = np.empty(n, np.uint32), np.empty(n, np.uint32)
        for i in range(61):                                  # the last three steps make the other 96 bits
            if i < 16:
                k = i
                np.bitwise_xor(c, d, out=f)
                np.bitwise_and(f, b, out=f)
                np.bitwise_xor(f, d, out=f)
            elif i < 32:
                k = (5 * i + 1) % 16
                np.bitwise_xor(b, c, out=f)
                np.bitwise_and(f, d, out=f)
                np.bitwise_xor(f, c, out=f)
            elif i < 48:
                k = (3 * i + 5) % 16
                np.bitwise_xor(b, c, out=f)
                np.bitwise_xor(f, d, out=f)
            else:
                k = 7 * i % 16
                np.invert(d, out=f)
                np.bitwise_or(f, b, out=f)
                np.bitwise_xor(f, c, out=f)
            f += a
            if isinstance(words[k], int):
                f += np.uint32((adds[i] + words[k]) & 0xFFFFFFFF)
            else:
                f += words[k]
                f += np.uint32(adds[i])
            np.left_shift(f, np.uint32(turns[i]), out=g)
            np.right_shift(f, np.uint32(32 - turns[i]), out=f)
            f |= g
            f += b
            a, b, c, d, f = d, f, b, c, a
        return (b + np.uint32(0x67452301)).byteswap()

    def of_block(found: list[np.ndarray], at: np.ndarray, prefix: np.ndarray, place: np.ndarray, digits: int, tails: list[bytes]) -> None:
        n, size = prefix.shape
        begin = size + 1 + digits                            # where the tail begins
        text = np.zeros((n, 64), np.uint8)
        text[:, :size] = prefix
        text[:, size] = ord("|")
        for k in range(digits):
            text[:, begin - 1 - k] = 48 + place % 10
            place = place // 10
        words = text.view("<u4")
        same = [np.ascontiguousarray(words[:, k]) for k in range(begin // 4)]
        for out, tail in zip(found, tails):
            end = begin + len(tail)
            text[:, begin:56] = 0
            text[:, begin:end] = np.frombuffer(tail, np.uint8)
            text[:, end] = 0x80
            told = same + [np.ascontiguousarray(words[:, k]) for k in range(begin // 4, end // 4 + 1)]
            out[at] = heads(told + [0] * (14 - len(told)) + [8 * end, 0], n)

    def draws(keys: pa.Array, row: np.ndarray, place: np.ndarray, tails: list[str], block: int = 1 << 13) -> list[np.ndarray]:
        ends = [b"|" + t.encode() for t in tails]
        found = [np.empty(len(row), np.uint32) for _ in ends]
        if not len(row):
            return found
        keys = keys.cast(pa.binary())
        begins = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset:keys.offset + len(keys) + 1].astype(np.int64)
        data = np.frombuffer(keys.buffers()[2], np.uint8)
        size = np.diff(begins)[row]
        digits = np.searchsorted(10 ** np.arange(1, 19), place, "right") + 1
        kind = size * 20 + digits
        for told in np.unique(kind):
            at = np.flatnonzero(kind == told)
            length, written = divmod(int(told), 20)
            if length + 1 + written + max(map(len, ends)) > 55:
                for i in at:
                    head = keys[int(row[i])].as_py() + b"|%d" % place[i]
                    for out, end in zip(found, ends):
                        out[i] = int.from_bytes(hashlib.md5(head + end).digest()[:4])
                continue
            for lo in range(0, len(at), block):
                part = at[lo:lo + block]
                of_block(found, part, data[begins[row[part]][:, None] + np.arange(length)], place[part], written, ends)
        return found

    return draws
