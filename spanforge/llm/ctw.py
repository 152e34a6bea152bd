"""Language-model scoring by context-tree weighting over bytes (operator 12).

Each byte is coded as its eight binary decisions.  For every node of that decision tree
a context tree holds, for the contexts of 0 to ``depth`` preceding bytes, how often the
decision fell to 0 and to 1 in training.  A node's Krichevsky-Trofimov block probability
Pe follows from its two counts; its weighted probability is Pw = Pe at full depth, else
(Pe + product of the children's Pw) / 2.  A decision's probability mixes the estimates
of all depths along its context: Pe / 2 Pw of a node's weight stays with its own
estimate, the rest goes to the child that the next context byte names.  An unseen node
says 1/2.  The code length of a text is the sum over its bytes and an end sign.

The counts are those of distinct (depth + 1)-byte grams, taken over all training texts;
they grow with the corpus and never leave Spark.  A gram's key begins with the nearest
context byte, so all nodes below a two-byte context lie side by side: grams are
distributed by that context and the trees below it are weighted task by task, at most
256^(depth - 1) grams at a time.  Only the two topmost levels (65,792 nodes
at most, whatever the corpus) meet on the driver.  As the statistics are frozen, a
gram's code length is a number: each distinct gram of the corpus is priced once.  The
``frequent`` most frequent grams and words are broadcast, a fixed number, so that
nearly every occurrence is priced in its row; the others go through a join, in which
no key is hot any more.

Tokens, for the unigram base: runs of bytes outside ``\\x20\\x09-\\x0D`` after
lower-casing A-Z, told apart by 128 bits of hash, then one end token per text.

Defined results: null and empty texts have the end token alone; a null doc_id is a key
like any other; repeated rows repeat, and count in training as often as they occur;
without training texts every decision is 1/2 and every base factor is 1; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .scratch import map_batches, materialise
from .wordarrays import BYTE_VALUE, Words, buffer_of, byte_slices, mix64, powers, string_column

END = 0xFF                       # in no UTF-8 text
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_HELD = 1 << 20                  # distinct keys a task holds before it hands them on
_CHUNK = 1 << 18                 # grams weighted at a time, and the rest of a two-byte context


# --- keys ------------------------------------------------------------------------
def grams(data: np.ndarray, off: np.ndarray, lo: int, hi: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys of every byte and end sign of the rows, offsets per row).  A key is the
    nearest context byte, the one before it, ..., and last the byte itself; end signs
    stand before a text."""
    start, stop = int(off[lo]), int(off[hi])
    size = np.diff(off[lo:hi + 1]) + 1
    at = np.concatenate(([0], np.cumsum(size)))
    n = int(at[-1])
    signs = np.full(n, END, dtype=np.uint64)
    inner = np.ones(n, dtype=bool)
    inner[at[1:] - 1] = False
    signs[inner] = _LOWER[data[start:stop]]
    key = signs.copy()
    for back in range(1, depth + 1):
        before = np.full(n, END, dtype=np.uint64)
        before[back:] = signs[:-back] if back < n else 0
        for place in range(back):                # too near the start of the text
            near = at[:-1] + place
            before[near[near < at[1:]]] = END
        key |= before << np.uint64(8 * (depth + 1 - back))
    return key, at


def word_keys(words: Words) -> np.ndarray:
    """Two 64-bit hashes of each lower-cased word, as one (n, 2) array."""
    low = _LOWER[words.data]
    out = np.empty((len(words.start), 2), dtype=np.uint64)
    size = (words.end - words.start).astype(np.uint64)
    for which, value in enumerate((BYTE_VALUE, mix64(BYTE_VALUE + np.uint64(1)))):
        up, down = powers(which, len(low) + 1)
        sums = np.zeros(len(low) + 1, dtype=np.uint64)
        np.cumsum(value[low] * up[:-1], dtype=np.uint64, out=sums[1:])
        out[:, which] = mix64((sums[words.end] - sums[words.start]) * down[words.start] + size)
    return out


class _Counter:
    """Counts of keys in training texts and in all texts, in bounded memory."""

    def __init__(self, width: int):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held, self.width = 0, width

    def add(self, keys: np.ndarray, training: np.ndarray) -> None:
        for part, flag in ((keys[training], 1), (keys[~training], 0)):
            if len(part):
                found, n = _distinct(part, None)
                self.parts.append((found, np.stack((n * flag, n), axis=1)))
                self.held += len(found)

    def take(self, least: int) -> tuple[np.ndarray, np.ndarray] | None:
        """What is held, if it is more than ``least`` keys."""
        if self.held <= least or not self.parts:
            return None
        found, n = _distinct(np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts]))
        if len(found) <= least:
            self.parts, self.held = [(found, n)], len(found)
            return None
        self.parts, self.held = [], 0
        return found, n


def _distinct(keys: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct keys, their number or sum of weights)."""
    if keys.ndim == 1 and weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable") if keys.ndim == 1 else np.lexsort((keys[:, 1], keys[:, 0]))
        keys = keys[order]
    new = keys[1:] != keys[:-1] if keys.ndim == 1 else (keys[1:] != keys[:-1]).any(axis=1)
    first = np.concatenate(([0], np.flatnonzero(new) + 1))
    if weights is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(weights[order], first, axis=0)


def counts(docs: DataFrame, depth: int) -> DataFrame:
    """``(text, training)`` -> ``(kind, k1, k2, n, n_all)``: occurrences of each gram
    (kind 0) and word (kind 1) in training texts and in all texts."""

    def rows(kind: int, got: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        keys, n = got
        k1, k2 = (keys, np.zeros(len(keys), np.uint64)) if keys.ndim == 1 else (keys[:, 0], keys[:, 1])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), kind, np.int32)), pa.array(k1.copy().view(np.int64)),
             pa.array(k2.copy().view(np.int64)), pa.array(n[:, 0]), pa.array(n[:, 1])],
            names=["kind", "k1", "k2", "n", "n_all"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (_Counter(1), _Counter(2))
        for b in batches:
            data, off = buffer_of(string_column(b.column(0)))
            training = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi in byte_slices(off):
                key, at = grams(data, off, lo, hi, depth)
                held[0].add(key, np.repeat(training[lo:hi], np.diff(at)))
                words = Words(data, off, lo, hi)
                held[1].add(word_keys(words), np.repeat(training[lo:hi], np.diff(words.row)))
                for kind, h in enumerate(held):
                    got = h.take(_HELD)
                    if got:
                        yield rows(kind, got)
        for kind, h in enumerate(held):
            got = h.take(0)
            if got:
                yield rows(kind, got)

    return (map_batches(docs.select("text", "training"), run, "kind int, k1 long, k2 long, n long, n_all long")
            .groupBy("kind", "k1", "k2").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all")))


# --- the trees -------------------------------------------------------------------
_SMALL = np.concatenate(([0.5 * math.log(math.pi)], np.zeros(255)))
for _i in range(1, 256):
    _SMALL[_i] = _SMALL[_i - 1] + math.log(_i - 0.5)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma by Stirling's series, for x of at least 100."""
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)


def _log_gamma_half(n: np.ndarray) -> np.ndarray:
    """ln Gamma(n + 1/2) of whole numbers."""
    return np.where(n < 256, _SMALL[np.minimum(n, 255).astype(np.int64)], _log_gamma(np.maximum(n, 256) + 0.5))


_FACTORIAL = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, 256)))))


def _log_factorial(n: np.ndarray) -> np.ndarray:
    return np.where(n < 256, _FACTORIAL[np.minimum(n, 255).astype(np.int64)], _log_gamma(np.maximum(n, 256) + 1.0))


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov block probability."""
    return _log_gamma_half(zeros) + _log_gamma_half(ones) - math.log(math.pi) - _log_factorial(zeros + ones)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    found, where = np.unique(keys, return_inverse=True)
    return (found, *(np.bincount(where, weights=v, minlength=len(found)) for v in values))


class Level:
    """The nodes of one depth: keys (context, then decision node 1..255), counts of the
    two outcomes, ln Pw, and the share of a node's own estimate."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        """``below``: ln of the product of the children's Pw (none at full depth)."""
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = log_kt(zeros, ones)
        self.log_pw = own if below is None else np.logaddexp(own, below) - math.log(2)
        self.own = np.ones(len(keys)) if below is None else np.exp(own - math.log(2) - self.log_pw)

    def above(self) -> tuple[np.ndarray, ...]:
        """Keys, counts and ln products that the next level up gets."""
        parent = ((self.keys >> np.uint64(16)) << np.uint64(8)) | (self.keys & np.uint64(255))
        return _summed(parent, self.zeros, self.ones, self.log_pw)

    def mixed(self, nodes: np.ndarray, bits: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        """Probability of the decisions, ``deeper`` being what the child says."""
        if not len(self.keys):
            return np.full(nodes.shape, 0.5)
        at = np.minimum(np.searchsorted(self.keys, nodes), len(self.keys) - 1)
        zeros, ones = self.zeros[at], self.ones[at]
        estimate = (np.where(bits, ones, zeros) + 0.5) / (zeros + ones + 1)
        share = self.own[at]
        return np.where(self.keys[at] == nodes, share * estimate + (1 - share) * deeper, 0.5)


def _decisions(keys: np.ndarray, depth: int, full: int) -> tuple[np.ndarray, np.ndarray]:
    """(node keys, outcomes) of the eight decisions of each gram at a depth."""
    byte = (keys & np.uint64(255))[:, None]
    turn = np.arange(8, dtype=np.uint64)
    node = (np.uint64(1) << turn) | (byte >> (np.uint64(8) - turn))
    context = (keys >> np.uint64(8 * (full + 1 - depth)))[:, None] if depth else np.zeros_like(byte)
    return (context << np.uint64(8)) | node, ((byte >> (np.uint64(7) - turn)) & np.uint64(1)).astype(bool)


def lower_levels(keys: np.ndarray, n: np.ndarray, full: int) -> list[Level]:
    """The levels ``full`` up to 2 of whole two-byte contexts, from their grams."""
    seen = n > 0
    nodes, bits = _decisions(keys[seen], full, full)
    weight = np.broadcast_to(n[seen, None], nodes.shape)
    found, zeros, ones = _summed(nodes.reshape(-1), np.where(bits, 0, weight).reshape(-1),
                                 np.where(bits, weight, 0).reshape(-1))
    levels = [Level(found, zeros, ones, None)]
    for _ in range(full - 2):
        levels.append(Level(*levels[-1].above()))
    return levels


def _whole_contexts(batches: Iterator[pa.RecordBatch], full: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sorted (keys, n, n_all) rows, cut where a two-byte context ends."""
    shift, held, size = np.uint64(8 * (full - 1)), [], 0

    def joined() -> list[np.ndarray]:
        return [np.concatenate([h[i] for h in held]) for i in range(3)]

    for b in batches:
        held.append((b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy(), b.column(2).to_numpy()))
        size += b.num_rows
        if size >= _CHUNK:
            whole = joined()
            context = whole[0] >> shift
            cut = int(np.searchsorted(context, context[-1]))
            if cut:
                yield tuple(x[:cut] for x in whole)
            held, size = [tuple(x[cut:] for x in whole)], len(context) - cut
    if size:
        yield tuple(joined())


class Top:
    """The levels 1 and 0: 65,280 and 255 nodes at most."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, log_pw: np.ndarray):
        order = np.argsort(keys)
        self.one = Level(keys[order], zeros[order], ones[order], log_pw[order])
        self.root = Level(*self.one.above())

    def bits(self, keys: np.ndarray, full: int, deeper: np.ndarray) -> np.ndarray:
        p = self.one.mixed(*_decisions(keys, 1, full), deeper)
        return -np.log2(self.root.mixed(*_decisions(keys, 0, full), p)).sum(axis=1)


def priced(table: DataFrame, full: int) -> DataFrame:
    """``(k1, n, n_all)`` of all distinct grams -> ``(k1, n_all, bits)``, the code length
    of each gram's last byte after the others, trained on the ``n``."""
    spark = table.sparkSession
    context = F.shiftrightunsigned(F.col("k1"), 8 * (full - 1))
    laid = table.select("k1", "n", "n_all").repartition(context).sortWithinPartitions("k1")

    def upward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n, _ in _whole_contexts(batches, full):
            up = lower_levels(keys, n, full)[-1].above()
            yield pa.RecordBatch.from_arrays([pa.array(up[0].view(np.int64)), *map(pa.array, up[1:])],
                                             names=["node", "zeros", "ones", "log_pw"])

    rows = (map_batches(laid, upward, "node long, zeros double, ones double, log_pw double").groupBy("node")
            .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_pw").alias("log_pw"))).collect()
    columns = np.array([tuple(r) for r in rows], dtype=np.float64).reshape(-1, 4)
    top = spark.sparkContext.broadcast(Top(columns[:, 0].astype(np.uint64), *columns[:, 1:].T))

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n, n_all in _whole_contexts(batches, full):
            levels = lower_levels(keys, n, full)
            for i in range(0, len(keys), 1 << 16):
                part = keys[i:i + (1 << 16)]
                p = np.full((len(part), 8), 0.5)
                for depth, level in zip(range(full, 1, -1), levels):
                    p = level.mixed(*_decisions(part, depth, full), p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.view(np.int64)), pa.array(n_all[i:i + (1 << 16)]),
                     pa.array(top.value.bits(part, full, p))], names=["k1", "n_all", "bits"])

    return map_batches(laid, price, "k1 long, n_all long, bits double")


# --- scoring ---------------------------------------------------------------------
def _frequent(table: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, those with the largest ``n_all``: the bar comes from a
    histogram of eighths of binary logarithms, so it asks for no sort."""
    step = F.floor(8 * F.log2(F.col("n_all").cast("double")))
    sizes = dict((r[0], r[1]) for r in table.groupBy(step.alias("step")).count().collect())   # some 500 steps at most
    bar, taken = None, 0
    for s in sorted(sizes, reverse=True):
        if taken + sizes[s] > most:
            break
        bar, taken = s, taken + sizes[s]
    return table.filter(F.lit(False) if bar is None else step >= bar)


class Known:
    """Values of a bounded set of keys, in a table with open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        """``keys``: 1 or 2 uint64 columns; ``values``: one row per key."""
        self.keys, self.values = keys if keys.ndim == 2 else keys[:, None], values
        size = 1 << max(10, (4 * len(keys)).bit_length())
        self.mask = np.int64(size - 1)
        self.slot = np.full(size, -1, dtype=np.int32)
        left, at = np.arange(len(keys), dtype=np.int32), self._home(self.keys[:, 0])
        while len(left):
            free = self.slot[at] < 0
            self.slot[at[free]] = left[free]             # of several the last one written stays
            lost = self.slot[at] != left
            left, at = left[lost], (at[lost] + 1) & self.mask

    def _home(self, key: np.ndarray) -> np.ndarray:
        return (mix64(key) >> np.uint64(20)).astype(np.int64) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is none."""
        keys = keys if keys.ndim == 2 else keys[:, None]
        out = np.full(len(keys), -1, dtype=np.int64)
        left, at = np.arange(len(keys)), self._home(keys[:, 0])
        while len(left):
            row = self.slot[at]
            some = row >= 0
            left, at, row = left[some], at[some], row[some]
            same = (self.keys[row, 0] == keys[left, 0])
            if keys.shape[1] > 1:
                same &= self.keys[row, 1] == keys[left, 1]
            out[left[same]] = row[same]
            left, at = left[~same], (at[~same] + 1) & self.mask
        return out


def _row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[at[1:]] - total[at[:-1]]


def _lists(keys: np.ndarray, row: np.ndarray, rows: int, names: list[str]) -> pa.Array:
    """Per row the distinct keys with their numbers, as a list of structs."""
    columns = [keys] if keys.ndim == 1 else [keys[:, 0], keys[:, 1]]
    order = np.lexsort((*reversed(columns), row))
    row, columns = row[order], [c[order] for c in columns]
    new = np.ones(len(row), dtype=bool)
    if len(row):
        new[1:] = row[1:] != row[:-1]
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(row)))
    fields = [pa.array(c[first].view(np.int64)) for c in columns] + [pa.array(n.astype(np.int64))]
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row[first], np.arange(rows + 1)).astype(np.int32)),
                                    pa.StructArray.from_arrays(fields, names=[*names, "times"]))


def score(docs: DataFrame, training: Column | None = None, depth: int = 4, frequent: int = 1 << 18) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, n_tokens, n_known, train_tokens, base_score,
    n_signs, score)``, a row per row.

    ``training``: which rows are learned from (default: all).  score is log10 of the
    probability that the trees give the whole text, n_signs its bytes and the end sign
    (so -score / log10(2) / n_signs is the code length per byte); base_score is the sum
    over tokens of log10((c + 0.5) / (N + 0.5 (V + 1))).  ``depth`` is 2 to 6."""
    if not 2 <= depth <= 6:
        raise ValueError("depth is 2 to 6")
    spark = docs.sparkSession
    chosen = F.lit(True) if training is None else F.coalesce(training, F.lit(False))
    rows = docs.select("doc_id", "text", chosen.alias("training"))
    table = materialise(counts(rows, depth), "counts")
    words = table.filter("kind = 1").select("k1", "k2", "n", "n_all")
    facts = words.agg(F.sum("n"), F.sum((F.col("n") > 0).cast("long"))).first()
    ends = rows.filter("training").count()
    tokens, kinds = (facts[0] or 0) + ends, (facts[1] or 0) + (ends > 0)
    below = math.log10(tokens + 0.5 * (kinds + 1))
    prices = materialise(priced(table.filter("kind = 0"), depth), "prices")

    got = _frequent(prices, frequent).select("k1", "bits").toPandas()               # a fixed number of rows
    known_grams = spark.sparkContext.broadcast(
        Known(got["k1"].to_numpy(np.int64).view(np.uint64), got["bits"].to_numpy(np.float64)))
    got = _frequent(words, frequent).select("k1", "k2", "n").toPandas()
    known_words = spark.sparkContext.broadcast(
        Known(got[["k1", "k2"]].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_gram, by_word = known_grams.value, known_words.value
        log_count = np.log10(by_word.values + 0.5) - below
        for b in batches:
            data, off = buffer_of(string_column(b.column(1)))
            for lo, hi in byte_slices(off):
                key, at = grams(data, off, lo, hi, depth)
                found = by_gram.find(key)
                hit = found >= 0
                bits = np.zeros(len(key))
                bits[hit] = by_gram.values[found[hit]]
                far = np.flatnonzero(~hit)
                far_grams = _lists(key[far], np.searchsorted(at, far, side="right") - 1, hi - lo, ["k1"])
                words = Words(data, off, lo, hi)
                spelled = word_keys(words)
                found = by_word.find(spelled)
                hit = found >= 0
                base, seen = np.zeros(len(spelled)), np.zeros(len(spelled), np.int64)
                base[hit], seen[hit] = log_count[found[hit]], by_word.values[found[hit]] > 0
                far = np.flatnonzero(~hit)
                far_words = _lists(spelled[far], np.searchsorted(words.row, far, side="right") - 1, hi - lo, ["k1", "k2"])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(np.diff(words.row).astype(np.int64)),
                     pa.array(_row_sums(seen, words.row)), pa.array(_row_sums(base, words.row)),
                     pa.array(np.diff(at).astype(np.int64)), pa.array(_row_sums(bits, at)), far_grams, far_words],
                    names=["doc_id", "words", "seen", "base", "n_signs", "bits", "far_grams", "far_words"])

    own = map_batches(rows.select("doc_id", "text"), run,
                      f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, words long, seen long, base double, "
                      "n_signs long, bits double, far_grams array<struct<k1:long,times:long>>, "
                      "far_words array<struct<k1:long,k2:long,times:long>>")
    own = materialise(own.withColumn("row", F.monotonically_increasing_id()), "rows")   # written, so the number stays
    grams_left = (own.select("row", F.inline("far_grams")).join(prices.select("k1", "bits"), "k1")
                  .select("row", (F.col("times") * F.col("bits")).alias("more_bits"),
                          F.lit(0.0).alias("more_base"), F.lit(0).cast("long").alias("more_seen")))
    words_left = (own.select("row", F.inline("far_words")).join(words.select("k1", "k2", "n"), ["k1", "k2"])
                  .select("row", F.lit(0.0).alias("more_bits"),
                          (F.col("times") * (F.log10(F.col("n") + 0.5) - below)).alias("more_base"),
                          F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("more_seen")))
    more = (grams_left.unionByName(words_left).groupBy("row")
            .agg(*[F.sum(c).alias(c) for c in ("more_bits", "more_base", "more_seen")]))
    end = math.log10(ends + 0.5) - below
    total = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return own.join(more, "row", "left").select(
        "doc_id", (F.col("words") + 1).alias("n_tokens"),
        (total("seen", "more_seen") + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (total("base", "more_base") + F.lit(end)).alias("base_score"), "n_signs",
        (total("bits", "more_bits") * F.lit(-math.log10(2))).alias("score"))
