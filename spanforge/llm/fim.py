"""Fill-in-middle by SWAR words (operator 13).

The UTF-8 buffer of a slice of texts is viewed as uint64 words.  Eight bytes at a time
are compared arithmetically; the top bit of each matching byte is its mark.
``bitwise_count`` and a running sum give the marks before each word, so the k-th mark of
a text is found by a search for its word among the sums, and inside the word by adding
up the marks of the lower bytes with one multiplication and comparing them at once.
Texts are cut at such places without splitting them into units.

Defined results: a null text is treated as the empty one, which is plain; a null doc_id
draws as the empty text; repeated rows repeat, and draw alike if their doc_id is equal;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import map_batches
from .wordarrays import buffer_of, byte_slices, string_column

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
_ONES = np.uint64(0x0101010101010101)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_TOP = np.uint64(0x8080808080808080)


def words_of(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian uint64 words, filled up with zeros and one zero word more."""
    padded = np.zeros((len(data) // 8 + 1) * 8, dtype=np.uint8)
    padded[:len(data)] = data
    return padded.view("<u8")


def equal_to(words: np.ndarray, byte: int) -> np.ndarray:
    """Marks of the bytes with this value."""
    x = words ^ (_ONES * np.uint64(byte))
    return ~(((x & _LOW) + _LOW) | x) & _TOP


def first_bytes(words: np.ndarray) -> np.ndarray:
    """Marks of the bytes that begin a code point: all but 10xxxxxx."""
    return ~(words & ~(words << np.uint64(1))) & _TOP


class Marks:
    """Rank and select over the marked bytes of a buffer."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(marks), dtype=np.int64, out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before each byte position."""
        word = at >> 3
        below = (np.uint64(1) << ((at & 7) << 3).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th mark, counted from 0."""
        word = np.searchsorted(self.before, k, side="right") - 1
        inside = (k - self.before[word]).astype(np.uint64)
        upto = (self.marks[word] >> np.uint64(7)) * _ONES       # byte i: marks in the bytes 0..i, 8 at most
        past = (upto + (np.uint64(127) - inside) * _ONES) & _TOP
        return (word << 3) + 8 - np.bitwise_count(past)


class Units:
    """Lines (``[^\\n]*\\n|[^\\n]+``) or code points of the rows [a, b) of a buffer."""

    def __init__(self, data: np.ndarray, off: np.ndarray, a: int, b: int, unit: str):
        lo, hi = int(off[a]), int(off[b])
        self.data, self.unit = data[lo:hi], unit
        self.start, self.end = off[a:b] - lo, off[a + 1:b + 1] - lo
        words = words_of(self.data)
        self.points = Marks(first_bytes(words))
        if unit == "char":
            self.marks = self.points
            self.base = self.marks.rank(self.start)
            self.count = self.marks.rank(self.end) - self.base
        elif unit == "line":
            self.marks = Marks(equal_to(words, 0x0A))
            self.base = self.marks.rank(self.start)
            some = self.end > self.start
            last = np.zeros(b - a, dtype=np.uint8)
            last[some] = self.data[self.end[some] - 1]
            self.count = self.marks.rank(self.end) - self.base + (some & (last != 0x0A))
        else:
            raise ValueError(f"unit {unit!r}: line or char")

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Byte position behind the first k units of each row."""
        out = np.where(k <= 0, self.start, self.end)
        inner = np.flatnonzero((k > 0) & (k < self.count))
        # a line ends behind its mark, a code point before the next one's
        back = 1 if self.unit == "line" else 0
        out[inner] = self.marks.select(self.base[inner] + k[inner] - back) + back
        return out

    def chars(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Code points of the byte ranges."""
        return self.points.rank(hi) - self.points.rank(lo)


def _draws(seed: str):
    """Four unsigned 32-bit draws of a row: the leading groups of a hash of its doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, unit: str = "line", seed: str = "7", rate: int = 100, spm: int = 50) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, n, form, prefix_chars, middle_chars, output)``, a row per row.

    A text of n units is cut behind two drawn numbers of units.  ``rate`` of a hundred
    documents are transformed, ``spm`` of a hundred of them with the suffix first; a text
    that is empty or holds a sentinel stays plain (its two lengths are null)."""
    drawn = docs.select("doc_id", "text", *_draws(seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = buffer_of(string_column(b.column(1)))
            h = [b.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6)]
            for lo, hi in byte_slices(off):
                units = Units(data, off, lo, hi, unit)
                n = units.count
                one, two = h[0][lo:hi] % (n + 1), h[1][lo:hi] % (n + 1)
                first, second = units.cut(np.minimum(one, two)), units.cut(np.maximum(one, two))
                raw = units.data.tobytes()
                form, output = [], []
                for i, (s, p, m, e) in enumerate(zip(units.start.tolist(), first.tolist(), second.tolist(),
                                                     units.end.tolist())):
                    text = raw[s:e]
                    if (s == e or h[2][lo + i] % 100 >= rate
                            or PREFIX in text or SUFFIX in text or MIDDLE in text):
                        form.append(PLAIN)
                        output.append(text)
                    elif h[3][lo + i] % 100 < spm:
                        form.append(SPM)
                        output.append(b"".join((SUFFIX, raw[m:e], PREFIX, raw[s:p], MIDDLE, raw[p:m])))
                    else:
                        form.append(PSM)
                        output.append(b"".join((PREFIX, raw[s:p], SUFFIX, raw[m:e], MIDDLE, raw[p:m])))
                plain = np.array([f == PLAIN for f in form], dtype=bool)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(units.chars(units.start, first), pa.int64(), mask=plain),
                     pa.array(units.chars(first, second), pa.int64(), mask=plain),
                     pa.array(output, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return map_batches(drawn, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, form string, "
                                   "prefix_chars long, middle_chars long, output string")


def _rebuilt(output: str, form: str) -> str:
    p, s, m = PREFIX.decode(), SUFFIX.decode(), MIDDLE.decode()
    if form == PLAIN:
        return output
    rest, middle = output.split(m)
    if form == PSM:
        prefix, suffix = rest[len(p):].split(s)
    else:
        suffix, prefix = rest[len(s):].split(p)
    return prefix + middle + suffix


def restore(transformed: DataFrame) -> DataFrame:
    """Adds ``restored``, the exact text rebuilt from ``output`` and ``form`` alone."""
    names = transformed.columns
    at, how = names.index("output"), names.index("form")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [_rebuilt(o.as_py(), f.as_py()) for o, f in zip(b.column(at), b.column(how))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*names, "restored"])

    return map_batches(transformed, run, transformed.withColumn("restored", F.lit("")).schema)
