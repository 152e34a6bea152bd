"""Language identification by prediction by partial matching (operator 5).

For each language a byte context tree of the orders 0..``order`` holds how often
each byte followed each context.  The statistics are frozen after training.  A
byte's code length in a context that was seen is -log2 n(c, s) / (n(c) + t(c)),
where t(c) counts the distinct bytes seen after c; a byte not seen there escapes
at t(c) / (n(c) + t(c)) to the context that is one byte shorter, at last to 1/256
for each byte.  A context never seen costs nothing to leave.  A text's exact code
length is the sum over all its bytes; the language with the shortest code wins.

Under frozen statistics the cost depends on the byte and the ``order`` bytes before
it only, so each distinct (order + 1)-gram of a slice of texts is priced once per
language and the prices are added up by text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .scratch import map_batches
from .wordarrays import buffer_of, byte_slices, string_column

_LETTER = regex.compile(r"\p{L}")
_SLICE = 2 << 20


def _grams(data: np.ndarray, off: np.ndarray, order: int) -> np.ndarray:
    """Each byte with the ``order`` bytes before it, as one number; a blank stands
    before a text's first byte."""
    n = len(data)
    code = data.astype(np.uint32)
    row = np.repeat(off[:-1], np.diff(off))
    place = np.arange(n) - row
    for back in range(1, order + 1):
        before = np.full(n, 0x20, dtype=np.uint32)
        before[back:] = data[:-back] if back <= n else 0
        before[place < back] = 0x20
        code |= before << np.uint32(8 * back)
    return code


class ContextTree:
    """Frozen counts of one language, from (order + 1)-grams and their counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int):
        self.order = order
        self.levels = []
        for k in range(order + 1):
            keep = np.uint32((1 << 8 * (k + 1)) - 1) if k < 3 else np.uint32(0xFFFFFFFF)
            gram, where = np.unique(grams & keep, return_inverse=True)
            n = np.bincount(where, weights=counts, minlength=len(gram))
            context, where = np.unique(gram >> np.uint32(8), return_inverse=True)
            total = np.bincount(where, weights=n, minlength=len(context))
            kinds = np.bincount(where, minlength=len(context))
            self.levels.append((keep, gram, np.log2((total + kinds)[where] / n), context, np.log2((total + kinds) / kinds)))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Exact code length of the last byte of each gram."""
        cost, open_ = np.zeros(len(grams)), np.ones(len(grams), dtype=bool)
        for keep, gram, price, context, escape in reversed(self.levels):
            g = grams & keep
            at = np.minimum(np.searchsorted(gram, g), len(gram) - 1)
            hit = open_ & (gram[at] == g)
            cost[hit] += price[at[hit]]
            open_ &= ~hit
            c = g >> np.uint32(8)
            at = np.minimum(np.searchsorted(context, c), len(context) - 1)
            out = open_ & (context[at] == c)
            cost[out] += escape[at[out]]
        cost[open_] += 8.0
        return cost


def train(rows: DataFrame, order: int = 3, per_language: int = 2000) -> tuple[list[str], list[ContextTree]]:
    """Context trees from ``(doc_id, text, lang)`` rows with non-null text and lang.

    Of each language a share of its distinct texts is fitted, drawn by the text's
    hash: about ``per_language`` texts at most, whole, and all if it has no more.
    Copies count, are drawn and are fitted once.  What reaches the driver is bounded
    by that sample.
    """
    labelled = (rows.select("text", "lang").filter("text is not null and lang is not null and text != ''")
                .withColumn("draw", F.xxhash64("text")))
    sizes = labelled.select("lang", "draw").distinct().groupBy("lang").count()   # a row per language
    drawn = (labelled.join(F.broadcast(sizes), "lang")
             .filter(F.col("draw").bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40)) * F.col("count") <= per_language)
             .dropDuplicates(["lang", "draw"]))
    counted = map_batches(drawn, _count(order), "lang string, gram long, n long")
    table = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    trees, names = [], sorted(table["lang"].unique())
    for name in names:
        own = table[table["lang"] == name]
        trees.append(ContextTree(own["gram"].to_numpy().astype(np.uint32), own["n"].to_numpy(dtype=np.float64), order))
    return names, trees


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list] = {}
        for b in batches:
            texts, langs = string_column(b.column(b.schema.get_field_index("text"))), b.column(b.schema.get_field_index("lang"))
            for lang in langs.unique().to_pylist():
                data, off = buffer_of(texts.filter(pa.compute.equal(langs, lang)))
                for lo, hi in byte_slices(off, _SLICE):
                    start, stop = off[lo], off[hi]
                    gram, n = np.unique(_grams(data[start:stop], off[lo:hi + 1] - start, order), return_counts=True)
                    have = found.get(lang)
                    if have:
                        gram, where = np.unique(np.concatenate((have[0], gram)), return_inverse=True)
                        n = np.bincount(where, weights=np.concatenate((have[1], n))).astype(np.int64)
                    found[lang] = [gram, n]
        for lang, (gram, n) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(gram)), pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))],
                names=["lang", "gram", "n"])
    return run


def predict(docs: DataFrame, names: list[str], trees: list[ContextTree], order: int = 3) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, lang_pred, score)``, a row per row.

    score is the probability of the language if all are equally likely beforehand
    (2 to the minus code length, scaled to sum 1).  A null text or one without a
    letter, and any text if nothing was learned, is ``und`` with score 0; equal code
    lengths go to the first name; repeated rows repeat; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(trees)   # bounded by the training sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for b in batches:
            texts = string_column(b.column(1))
            data, off = buffer_of(texts)
            bits = np.zeros((len(models), len(texts)))
            for lo, hi in byte_slices(off, _SLICE):
                start, stop = off[lo], off[hi]
                if start == stop:
                    continue
                gram, where = np.unique(_grams(data[start:stop], off[lo:hi + 1] - start, order), return_inverse=True)
                at = off[lo:hi + 1] - start
                for i, m in enumerate(models):
                    total = np.concatenate(([0.0], np.cumsum(m.bits(gram)[where])))
                    bits[i, lo:hi] = total[at[1:]] - total[at[:-1]]
            known = [bool(models) and _LETTER.search(t.as_py()) is not None for t in texts]
            if models:
                best = bits.argmin(axis=0)
                score = 1 / np.exp2(np.maximum(bits.min(axis=0) - bits, -1000)).sum(axis=0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([names[best[i]] if k else "und" for i, k in enumerate(known)], pa.string()),
                 pa.array([float(score[i]) if k else 0.0 for i, k in enumerate(known)], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return map_batches(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
