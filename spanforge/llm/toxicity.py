"""Toxicity by weak supervision (operator 1).

Voters.  A bounded sample of labelled texts yields marker features: words, word
beginnings and word endings (3 to 6 bytes) that toxic texts hold far more often than
clean ones.  The markers are dealt into ``LEXICONS`` lexicons; a lexicon votes toxic
if it hits and abstains otherwise.  Pattern voters look at the number of hits, at
their density, at shouting and at calm texts; some of these vote clean.

Label model.  Every document of the corpus is voted on; the counts of distinct vote
patterns (3^voters at most) go into expectation-maximisation for each voter's rates
on toxic and clean texts.  Voters that see the same words agree more than their
rates explain: their correlations within a class are estimated from the same counts,
and a voter's weight is divided by the correlation it shares with the others.

Classifier.  A logistic regression on the markers, fitted to the posterior labels of
the sample's texts, scores every whole text.

Defined results: a null or empty text has no markers and gets the score of a text
without any; repeated rows repeat; labels that are null, or of unknown documents,
are ignored, of several labels of a document the largest counts; without labelled
texts of both classes every score is 0; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import map_batches, materialise, release
from .wordarrays import BYTE_VALUE, Words, buffer_of, byte_slices, mix64, powers, string_column

LEXICONS = 8
PATTERNS = ("many", "dense", "shouting", "none")
_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_VALUE = BYTE_VALUE.copy()
_VALUE[65:91] = BYTE_VALUE[97:123]
_BITS = 1 << 20


def _features(data: np.ndarray, off: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash) of every feature occurrence of the rows, and the words per row."""
    words = Words(data, off, lo, hi, _BETWEEN)
    up, down = powers(0, len(words.data) + 1)
    sums = np.zeros(len(words.data) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[words.data] * up[:-1], dtype=np.uint64, out=sums[1:])
    count = np.diff(words.row)
    row, size = np.repeat(np.arange(hi - lo), count), words.end - words.start
    rows, hashes = [row], [mix64((sums[words.end] - sums[words.start]) * down[words.start] + np.uint64(1))]
    for n in (3, 4, 5, 6):
        long = np.flatnonzero(size > n)
        s, e = words.start[long], words.end[long]
        rows += [row[long], row[long]]
        hashes += [mix64((sums[s + n] - sums[s]) * down[s] + np.uint64(10 + n)),
                   mix64((sums[e] - sums[e - n]) * down[e - n] + np.uint64(20 + n))]
    return np.concatenate(rows), np.concatenate(hashes), count


def _text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def labelled(docs: DataFrame, labels: DataFrame, per_class: int = 6000) -> DataFrame:
    """``(h, toxic)``: hashes of about ``per_class`` distinct labelled texts of each
    class at most, drawn by the hash: copies are drawn together, and once."""
    one = (labels.select("doc_id", "toxic").filter("doc_id is not null and toxic in (0, 1)")
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    texts = docs.select("doc_id", _text_hash().alias("h")).join(one, "doc_id").select("h", "toxic").distinct()
    texts = materialise(texts, "labelled")
    sizes = texts.groupBy("toxic").count()                     # two rows
    draw = F.col("h").bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))
    return materialise(texts.join(F.broadcast(sizes), "toxic").filter(draw * F.col("count") <= per_class)
                       .select("h", "toxic"), "sample")


def _bar(ratios: DataFrame, evidence: float, false_share: float) -> float:
    """The log-likelihood ratio from which at most ``false_share`` of the marked
    features are expected to be chance finds among all features seen; ``evidence``
    at most.  ``ratios``: ``(ratio, lifted)`` of every feature.  Benjamini and
    Hochberg's bound with the chi-squared tail, half of it (toxic side only), over
    counts by half a unit: the driver gets no more rows than steps up to ``evidence``."""
    steps = int(2 * evidence)
    counted = (ratios.groupBy(F.when(F.col("lifted"), F.least(F.floor(F.col("ratio") * 2), F.lit(steps)))
                              .alias("step")).count().collect())
    seen = sum(r["count"] for r in counted)
    above, bar = 0, evidence
    for step, n in sorted(((r["step"], r["count"]) for r in counted if r["step"] is not None), reverse=True):
        above += n
        if seen * math.erfc(math.sqrt(max(step, 0) / 4)) / 2 <= false_share * above:
            bar = min(bar, step / 2)
    return bar


def markers(docs: DataFrame, sample: DataFrame, lift: float = 2.5, evidence: float = 40.0,
            false_share: float = 0.001) -> np.ndarray:
    """Hashes of the features that mark toxic texts; the sample bounds their number.

    A feature counts once per distinct text of the sample; it must be e^lift times as
    frequent in toxic texts as in clean ones, and its log-likelihood ratio against
    being spread evenly must reach ``evidence``, which rare chance finds among millions
    of features don't.  Where that is more than half of what a feature of all toxic and
    no clean texts of the sample has, this half is enough, but never less than the bar
    at which chance finds make up ``false_share`` of the features marked.
    """
    drawn = (docs.select(_text_hash().alias("h"), "text").join(F.broadcast(sample), "h")   # the sample is bounded
             .groupBy("h", "toxic").agg(F.first("text").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = buffer_of(string_column(b.column(2)))
            toxic = np.asarray(b.column(1)).astype(np.int64)
            for lo, hi in byte_slices(off):
                row, h, _ = _features(data, off, lo, hi)
                order = np.lexsort((row, h))
                row, h = row[order], h[order]
                first = np.ones(len(h), dtype=bool)
                first[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                row, h = row[first], h[first]
                feature, where = np.unique(h, return_inverse=True)
                bad = np.bincount(where, weights=toxic[lo:hi][row], minlength=len(feature))
                n = np.bincount(where, minlength=len(feature))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(feature.view(np.int64)), pa.array(bad.astype(np.int64)),
                     pa.array((n - bad).astype(np.int64))], names=["feature", "bad", "good"])

    drawn = materialise(drawn, "drawn").select("h", "toxic", "text")
    sizes = {r.toxic: r["count"] for r in drawn.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return np.zeros(0, np.uint64)
    log_odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    both = F.col("bad") + F.col("good")
    ratio = (F.col("bad") * F.log(F.col("bad") * (bad + good) / (both * bad))
             + F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") * (bad + good) / (both * good))).otherwise(0.0))
    seen = materialise(map_batches(drawn, run, "feature long, bad long, good long")
                       .groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "features")
    lifted = (F.col("bad") > 0) & (log_odds >= lift)
    bar = max(min(evidence, bad * math.log((bad + good) / bad)),
              _bar(seen.select(F.when(lifted, 2 * ratio).alias("ratio"), lifted.alias("lifted")), evidence, false_share))
    best = seen.filter(lifted).filter(2 * ratio >= bar).select("feature").toArrow()     # features of a bounded sample
    return np.sort(np.asarray(best["feature"]).astype(np.int64).view(np.uint64))


def _maybe(keys: np.ndarray) -> np.ndarray:
    """Low bits of the markers, which most features of a text don't have."""
    maybe = np.zeros(_BITS, dtype=bool)
    maybe[(keys & np.uint64(_BITS - 1)).astype(np.int64)] = True
    return maybe


def _found(data: np.ndarray, off: np.ndarray, lo: int, hi: int, keys: np.ndarray,
           maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, marker) of each marker found, once per row, and the words per row."""
    row, h, n_words = _features(data, off, lo, hi)
    may = np.flatnonzero(maybe[(h & np.uint64(_BITS - 1)).astype(np.int64)])
    if not len(may):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), n_words
    at = np.minimum(np.searchsorted(keys, h[may]), len(keys) - 1)
    real = keys[at] == h[may]
    row, at = np.divmod(np.unique(row[may[real]] * len(keys) + at[real]), len(keys))
    return row, at, n_words


def votes(docs: DataFrame, known: np.ndarray, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, hits, v0..)`` per row: the markers found (numbers in ``known``, each
    once) and the votes (1 toxic, -1 clean, 0 abstains).  The columns ``keep`` (longs)
    go with them."""
    docs = docs.select("doc_id", "text", *keep)
    shared = docs.sparkSession.sparkContext.broadcast(known)   # bounded by the sample
    names = _voters()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value
        maybe = _maybe(keys)
        for b in batches:
            data, off = buffer_of(string_column(b.column(1)))
            for lo, hi in byte_slices(off):
                row, at, n_words = _found(data, off, lo, hi, keys, maybe)
                n = hi - lo
                hits = np.bincount(row, minlength=n)
                ends = np.concatenate(([0], np.cumsum(hits)))
                upper, letters = _case(data, off, lo, hi)
                cast = [np.bincount(row[at % LEXICONS == i], minlength=n) > 0 for i in range(LEXICONS)]
                cast = [c.astype(np.int64) for c in cast]
                cast += [np.where(hits >= 3, 1, np.where(hits == 0, -1, 0)),
                         np.where(20 * hits >= n_words, np.where(hits > 0, 1, 0), np.where(200 * hits < n_words, -1, 0)),
                         np.where((letters >= 20) & (2 * upper > letters), 1, 0),
                         np.where(hits == 0, -1, 0)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, n),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32())),
                     *[pa.array(c.astype(np.int8)) for c in cast], *[c.slice(lo, n) for c in b.columns[2:]]],
                    names=["doc_id", "hits", *names, *keep])

    return map_batches(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, hits array<int>, "
                           + ", ".join(f"{v} tinyint" for v in names) + "".join(f", {c} long" for c in keep))


def _voters() -> list[str]:
    return [f"v{i}" for i in range(LEXICONS + len(PATTERNS))]


def _case(data: np.ndarray, off: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    part = data[off[lo]:off[hi]]
    at = off[lo:hi + 1] - off[lo]
    big = np.concatenate(([0], np.cumsum((part >= 65) & (part <= 90))))
    small = np.concatenate(([0], np.cumsum((part >= 97) & (part <= 122))))
    upper = big[at[1:]] - big[at[:-1]]
    return upper, upper + small[at[1:]] - small[at[:-1]]


class LabelModel:
    """Rates and correlations of voters, by EM over counted vote patterns.

    ``rates[y, voter, vote + 1]`` is P(vote | class y).  EM starts from ``start``, which
    also weighs as one in a thousand of the documents, so that a voter that hardly
    ever votes keeps its rates."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, start: np.ndarray, share: float, rounds: int = 25):
        p, n = patterns.astype(np.int64), counts.astype(np.float64)
        held = max(1.0, 0.001 * n.sum())
        self.share, self.rates, self.weight = share, start.copy(), np.ones(p.shape[1])
        for _ in range(rounds):
            q = self.posterior(p)
            self.weight = self._weights(p, n, q)
            self.rates = rates(p, q, n, held, start)
            self.share = float(np.clip((q * n).sum() / max(n.sum(), 1e-9), 0.001, 0.5))

    def _weights(self, p: np.ndarray, n: np.ndarray, q: np.ndarray) -> np.ndarray:
        """How much of a voter's evidence is its own: R^-1 1 for the correlations R
        within the classes (the stronger of the two), kept within [0.1, 1]."""
        stronger = np.zeros((p.shape[1], p.shape[1]))
        for m in (q * n, (1 - q) * n):
            if m.sum() > 0:
                d = p - (p * m[:, None]).sum(0) / m.sum()
                cov = (d * m[:, None]).T @ d / m.sum()
                sd = np.sqrt(np.diag(cov))
                rho = cov / np.maximum(np.outer(sd, sd), 1e-6)
                stronger = np.maximum(stronger, np.clip(rho, 0, 0.95))
        np.fill_diagonal(stronger, 1.1)
        return np.clip(np.linalg.solve(stronger, np.ones(len(stronger))), 0.1, 1.0)

    def posterior(self, p: np.ndarray) -> np.ndarray:
        """Probability of toxic for rows of votes."""
        logs = np.log(self.rates[1] / self.rates[0]) * self.weight[:, None]
        logit = math.log(self.share / (1 - self.share)) + logs[np.arange(p.shape[1]), p.astype(np.int64) + 1].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def rates(p: np.ndarray, toxic: np.ndarray, n: np.ndarray, held: float, start: np.ndarray) -> np.ndarray:
    """P(vote | class) from votes, probabilities of toxic and counts, smoothed by
    ``held`` votes as in ``start``."""
    out = np.empty((2, p.shape[1], 3))
    for y, m in ((1, toxic * n), (0, (1 - toxic) * n)):
        for v in range(3):
            out[y, :, v] = ((p == v - 1) * m[:, None]).sum(0)
        out[y] += held * start[y]
    return out / out.sum(axis=2, keepdims=True)


def logistic(row: np.ndarray, col: np.ndarray, target: np.ndarray, size: int, rounds: int = 400) -> np.ndarray:
    """Weights of a logistic regression on binary features, the last one the bias;
    Nesterov's gradient steps with a small ridge."""
    n = len(target)
    w, look = np.zeros(size + 1), np.zeros(size + 1)
    base = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    look[-1] = w[-1] = math.log(base / (1 - base))
    per_row = np.bincount(row, minlength=n)
    rate = 4.0 / (1 + np.percentile(per_row, 95)) if n else 1.0
    for k in range(rounds):
        z = np.bincount(row, weights=look[col], minlength=n) + look[-1]
        gap = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - target
        grad = np.append(np.bincount(col, weights=gap[row], minlength=size), gap.sum()) / n + 1e-5 * look
        new = look - rate * grad
        look = new + k / (k + 3) * (new - w)
        w = new
    return w


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 6000) -> tuple[np.ndarray, np.ndarray]:
    """(markers, their weights and the bias) of the classifier; no markers, none.

    Labels are those to learn from; ``per_class`` bounds the distinct texts fitted."""
    sample = labelled(docs, labels, per_class)
    known = markers(docs, sample)
    if not len(known):
        return known, np.zeros(1)
    table = materialise(votes(docs.withColumn("__h", _text_hash()), known, ("__h",)), "votes")
    voters = _voters()
    counted = table.groupBy(*voters).count().collect()         # at most 3^voters patterns
    drawn = (table.join(F.broadcast(sample.select(F.col("h").alias("__sample"), "toxic")), F.col("__h") == F.col("__sample"))
             .groupBy("__sample", "toxic").agg(*[F.first(c).alias(c) for c in ("hits", *voters)])
             .orderBy("__sample", "toxic").toArrow())              # the sample, each text once
    release(table)
    votes_of = np.stack([np.asarray(drawn[v]) for v in voters], axis=1).astype(np.int64)
    truth = np.asarray(drawn["toxic"]).astype(np.float64)
    even = np.full((2, len(voters), 3), 1 / 3)
    start = rates(votes_of, truth, np.ones(len(truth)), 1.0, even)
    patterns = np.array([[r[v] for v in voters] for r in counted]).reshape(-1, len(voters))
    model = LabelModel(patterns, np.array([r["count"] for r in counted]), start, 0.1)
    target = model.posterior(votes_of)
    hits = drawn["hits"].combine_chunks()
    sizes = np.diff(np.asarray(hits.offsets))
    return known, logistic(np.repeat(np.arange(len(sizes)), sizes), np.asarray(hits.flatten()), target, len(known))


def _scores(model: tuple[np.ndarray, np.ndarray], texts: pa.Array, maybe: np.ndarray) -> np.ndarray:
    """Score of each text; one without markers has the bias alone."""
    known, weights = model
    if not len(known):
        return np.zeros(len(texts))
    data, off = buffer_of(string_column(texts))
    logit = np.full(len(texts), weights[-1])
    for lo, hi in byte_slices(off):
        row, at, _ = _found(data, off, lo, hi, known, maybe)
        logit[lo:hi] += np.bincount(row, weights=weights[at], minlength=hi - lo)
    return 1 / (1 + np.exp(-np.clip(logit, -700, 700)))


def score(docs: DataFrame, labels: DataFrame, per_class: int = 6000) -> DataFrame:
    """``(doc_id, text)`` and ``(doc_id, toxic)`` -> ``(doc_id, score)``, a row per row."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_class))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = _maybe(shared.value[0])
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_scores(shared.value, b.column(1), maybe))],
                                             names=["doc_id", "score"])

    return map_batches(docs.select("doc_id", "text"), run,
                       f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score at least ``threshold``, each by its own text,
    whatever its doc_id.  A score depends on the row alone, so no text is moved."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = _maybe(shared.value[0])
        for b in batches:
            yield b.filter(pa.array(_scores(shared.value, b.column(at), maybe) < threshold))

    return map_batches(docs, run, docs.schema)
