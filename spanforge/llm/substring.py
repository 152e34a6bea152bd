"""Exact substring dedup by seed and extend (operator 6).

A window is ``length`` consecutive words of one text; a word goes if a window
that covers it has a word sequence that starts anywhere else too.

Seeds: winnowing.  Among the ``anchor``-word grams inside a window the one with
the smallest hash is the window's anchor, so equal windows share their anchor at
the same offset, and a text has few anchors.  An anchor occurrence stands for
the run of windows that chose it; its context hash covers the words of that run.

Extension: occurrences are joined on the anchor.  If all occurrences of an
anchor agree in the context they match in full to both sides, and all their
windows repeat.  Where contexts differ, the match ends within reach of the
anchor: occurrences with an equal context match in full, and only one of them
and the single ones extend window by window, compared by a 128-bit hash of the
window's words.  The repeated windows' union is the set of maximal repeats of at
least ``length`` words.  Pairs of documents are never formed: each step is an
aggregate that combines map-side, or an equi-join against one row per key, which
adaptive execution can split when a key is hot.

Defined results: null and empty texts have no words; a text shorter than the
window keeps all its words; rows that repeat a doc_id, or have none, count as further places
(an exactly repeated row repeats all its windows); a null doc_id is a key like
any other; other columns pass through untouched; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F

from .bloom import bloom, join_few
from .scratch import map_batches, materialise, release, row_key
from .wordarrays import Words, buffer_of, byte_slices, mix64, string_column, window_hashes

_ROWS = 1 << 15   # rows of a result batch, and of a step of the window minimum


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows by a 128-bit hash of (doc_id, text): equal keys are exactly repeated rows."""
    return docs.select(row_key(1).alias("a"), row_key(2).alias("b"), "text")


class _Windows:
    """Anchors of the windows of a slice of rows."""

    def __init__(self, words: Words, length: int, anchor: int):
        h = words.hashes()
        n = len(h)
        row = np.repeat(np.arange(len(words.row) - 1), np.diff(words.row))
        self.start = np.flatnonzero(np.arange(n) + length <= words.row[row + 1])
        self.row = row[self.start]
        self.first = window_hashes(h, length, 1)
        self.words, self.size = h, length
        grams = window_hashes(h, anchor, 2)
        reach = length - anchor + 1
        self.anchor = np.empty(len(self.start), dtype=np.int64)
        if len(self.start):
            inside = sliding_window_view(grams, reach)
            for i in range(0, len(self.start), _ROWS):
                s = self.start[i:i + _ROWS]
                self.anchor[i:i + _ROWS] = s + inside[s].argmin(axis=1)
        self.gram = grams
        # windows with the same anchor follow each other; a row's end separates
        cut = np.flatnonzero(np.diff(self.anchor) | np.diff(self.row)) + 1
        self.run = np.concatenate(([0], cut)) if len(self.start) else np.zeros(0, np.int64)
        self.count = np.diff(np.concatenate((self.run, [len(self.start)]))) if len(self.start) else self.run

    def contexts(self) -> np.ndarray:
        """Per run: hash of the windows with their offsets from the anchor."""
        if not len(self.run):
            return np.zeros(0, np.uint64)
        return np.add.reduceat(mix64(self.first[self.start] + (self.anchor - self.start).astype(np.uint64)), self.run)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _batches(columns: list, names: list[str]) -> Iterator[pa.RecordBatch]:
    table = pa.RecordBatch.from_arrays(columns, names=names)
    for i in range(0, table.num_rows, _ROWS):
        yield table.slice(i, _ROWS)


def _anchors(docs: DataFrame, length: int, anchor: int, only=None) -> DataFrame:
    """A row per anchor occurrence: its hash, its context, and its run of windows
    (first start as word number in the text, count).  ``only``: a broadcast Bloom
    filter of the anchors asked for."""
    docs = _keyed(docs)

    def run(batches):
        for b in batches:
            data, off = buffer_of(string_column(b.column(2)))
            for lo, hi in byte_slices(off):
                words = Words(data, off, lo, hi)
                w = _Windows(words, length, anchor)
                if not len(w.run):
                    continue
                at, row, grams = w.start[w.run], w.row[w.run], w.gram[w.anchor[w.run]]
                found = [pa.array(row + lo), _signed(grams), _signed(w.contexts()),
                         pa.array((at - words.row[row]).astype(np.int32)), pa.array(w.count.astype(np.int32))]
                if only is not None:
                    asked = pa.array(only.value.may_hold(grams))
                    found = [c.filter(asked) for c in found]
                yield from _batches([b.column(0).take(found[0]), b.column(1).take(found[0]), *found[1:]],
                                    ["a", "b", "anchor", "context", "start", "windows"])

    return map_batches(docs, run, "a long, b long, anchor long, context long, start int, windows int")


def _same_row(left: DataFrame, right: DataFrame):
    return (left["a"] == right["__a"]) & (left["b"] == right["__b"])


def _extended(docs: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """The single windows of the asked runs: ``(a, b, start, h1, h2, single)``."""
    runs = asked.groupBy(F.col("a").alias("__a"), F.col("b").alias("__b")).agg(
        F.collect_set(F.struct("start", "windows", "single")).alias("runs"))  # bounded by the text's own anchors
    keyed = _keyed(docs)
    joined = keyed.join(runs, _same_row(keyed, runs)).select(
        "a", "b", "text", F.col("runs.start").alias("starts"), F.col("runs.windows").alias("counts"),
        F.col("runs.single").alias("singles"))

    def run(batches):
        for b in batches:
            data, off = buffer_of(string_column(b.column(2)))
            for lo, hi in byte_slices(off):
                words = Words(data, off, lo, hi)
                h = words.hashes()
                one, two = window_hashes(h, length, 1), window_hashes(h, length, 0)
                rows, starts, singles = [], [], []
                for r in range(lo, hi):
                    s = np.asarray(b.column(3)[r].values, dtype=np.int64)
                    c = np.asarray(b.column(4)[r].values, dtype=np.int64)
                    x = np.asarray(b.column(5)[r].values, dtype=np.int64)
                    total = int(c.sum())
                    within = np.arange(total) - np.repeat(np.cumsum(c) - c, c)
                    starts.append(np.repeat(s, c) + within)
                    singles.append(np.repeat(x, c))
                    rows.append(np.full(total, r))
                if not rows:
                    continue
                rows, starts = np.concatenate(rows), np.concatenate(starts)
                at = words.row[rows - lo] + starts
                yield from _batches(
                    [b.column(0).take(pa.array(rows)), b.column(1).take(pa.array(rows)),
                     pa.array(starts.astype(np.int32)), _signed(one[at]), _signed(two[at]),
                     pa.array(np.concatenate(singles))],
                    ["a", "b", "start", "h1", "h2", "single"])

    return map_batches(joined, run, "a long, b long, start int, h1 long, h2 long, single long")


def repeated_runs(docs: DataFrame, length: int = 35, anchor: int = 10) -> DataFrame:
    """``(a, b, start, windows)``: runs of repeated windows, rows by their key."""
    spark = docs.sparkSession
    # 1. seeds: anchors that occur at least twice, and whether all their contexts agree
    seeds = (_anchors(docs, length, anchor).groupBy(F.col("anchor").alias("__anchor"))
             .agg(F.count("*").alias("n"), F.min("context").alias("lo"), F.max("context").alias("hi"))
             .filter("n > 1").select("__anchor", (F.col("lo") != F.col("hi")).alias("differ")))
    seeds = materialise(seeds, "anchors")     # a table, so that the join below can split a hot anchor
    # most anchors occur once: a filter spares the join their rows
    only = spark.sparkContext.broadcast(bloom(seeds.select("__anchor")))
    found = _anchors(docs, length, anchor, only)
    found = materialise(found.join(seeds, found["anchor"] == seeds["__anchor"]).drop("__anchor"), "seeds")
    release(seeds)
    whole = found.filter("not differ").select("a", "b", "start", "windows")
    # 2. anchors whose contexts differ: equal contexts match in full
    differ = found.filter("differ")
    first = F.min(F.struct("a", "b", "start", "windows")).alias("at")
    classes = materialise(differ.groupBy("anchor", "context").agg(F.count("*").alias("n"), first), "contexts")
    groups = classes.filter("n > 1").select(F.col("anchor").alias("__anchor"), F.col("context").alias("__context"))
    groups_whole = (differ.join(groups, (differ["anchor"] == groups["__anchor"])
                                & (differ["context"] == groups["__context"]))
                    .select("a", "b", "start", "windows"))
    # 3. extend one occurrence of each context, window by window
    asked = classes.select("at.*", (F.col("n") == 1).cast("long").alias("single"))
    windows = materialise(_extended(docs, asked, length), "windows")
    twice = (windows.groupBy(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"))
             .agg(F.count("*").alias("n")).filter("n > 1").drop("n"))
    twice = materialise(twice, "repeated")
    own = windows.filter("single = 1")
    part = (own.join(twice, (own["h1"] == twice["__h1"]) & (own["h2"] == twice["__h2"]))
            .select("a", "b", "start", F.lit(1).alias("windows")))
    runs = materialise(whole.union(groups_whole).union(part).distinct(), "runs")   # a repeated row has its runs once
    release(found, classes, windows, twice)
    return runs


def _removed(n_words: int, runs, length: int) -> np.ndarray:
    """Boolean per word: covered by a repeated window."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    for start, windows in runs:
        edge[start] += 1
        edge[start + windows + length - 1] -= 1
    return np.cumsum(edge[:-1]) > 0


def _with_runs(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """``docs`` with ``__runs``, its repeated windows (null: none); a row per row."""
    runs = (repeated_runs(docs, length, anchor).groupBy("a", "b")
            .agg(F.collect_set(F.struct("start", "windows")).alias("__runs"))       # bounded by the text's own windows
            .withColumnsRenamed({"a": "__a", "b": "__b"}))
    runs = materialise(runs, "texts")        # a table, so that the join can split a hot row
    keyed = docs.withColumns({"__own_a": row_key(1), "__own_b": row_key(2)})
    return join_few(keyed, runs, [("__own_a", "__a"), ("__own_b", "__b")]).drop("__a", "__b", "__own_a", "__own_b")


def _runs_of(column: pa.Array, row: int) -> list[tuple[int, int]]:
    value = column[row].as_py()
    return [] if value is None else [(x["start"], x["windows"]) for x in value]


def repeats(docs: DataFrame, length: int = 35, anchor: int = 10) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, n_words, n_removed, kept)``, a row per row;
    kept is the text of the remaining words, joined by one space."""
    joined = _with_runs(docs.select("doc_id", "text"), length, anchor).select("doc_id", "text", "__runs")

    def run(batches):
        for b in batches:
            texts = string_column(b.column(1))
            n_words, n_removed, kept = [], [], []
            for r in range(b.num_rows):
                words = texts[r].as_py().encode().split()
                found = _runs_of(b.column(2), r)
                n_words.append(len(words))
                if found:
                    gone = _removed(len(words), found, length)
                    n_removed.append(int(gone.sum()))
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    n_removed.append(0)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return map_batches(joined, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, "
                                  "n_removed long, kept string")


def without_repeats(docs: DataFrame, length: int = 35, anchor: int = 10) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text``; a text that repeats
    nothing stays as it is, other columns too."""
    joined = _with_runs(docs, length, anchor)
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for b in batches:
            runs, texts = b.column(b.num_columns - 1), string_column(b.column(at))
            new = []
            for r in range(b.num_rows):
                found = _runs_of(runs, r)
                if found:
                    words = texts[r].as_py().encode().split()
                    gone = _removed(len(words), found, length).tolist()
                    new.append(b" ".join([w for w, g in zip(words, gone) if not g]).decode())
                else:
                    new.append(b.column(at)[r].as_py())
            columns = [pa.array(new, pa.string()) if i == at else b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(joined, run, docs.schema)
