"""Centroid clustering by equal-average equal-variance search (operator 11).

Vectors become integer vectors.  A vector's squared distance to a centroid is at least
k (difference of the means)^2 + (difference of the deviations)^2, the deviation being
the distance from the vector of one's own mean.  Centroids are sorted by mean; from a
vector's mean the search goes outward, ends where the difference of the means alone
exceeds the best distance, skips a centroid where both together exceed it, and computes
the distance of the others in integers.  A bound only rejects if it is greater by more
than its rounding error, so nearest centroids and ties are exact.

A round is one scan: tasks search their rows and hand on one sum per centroid and
component, which Spark adds up; the new centroids (k vectors) meet on the driver.
Components are int64 while they are small (below 2^25, so that distances fit); rows
with larger ones are computed with Python's integers, and their sums are handed on in
limbs, so any finite double is exact.

Defined results: vectors that don't have exactly ``size`` components, or hold a null or
non-finite one, have no row; rows that repeat a vec_id count each (ties in the draw of
centroids go by their components); a null vec_id draws as the empty text; with fewer
vectors than k there are fewer centroids; an empty cluster keeps its centroid; a
distance or sum beyond 64 bits is null; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import map_batches, materialise

SMALL, MEDIUM = 1 << 25, 1 << 28          # rows below the one, centroids below the other: distances fit in 63 bits
_ROWS, _LIMB = 1 << 14, 60
_MARGIN = 1e-9
_CAP = 10 ** 300


def quantised(x: float, scale: int) -> int:
    """floor(scale * x), exactly; scale is a power of two."""
    return math.floor(x * scale) if abs(x) < 1e300 else int(x) * scale


def spread(x: list[int]) -> int:
    """k squared deviations: k times the sum of squares, less the square of the sum."""
    return len(x) * sum(c * c for c in x) - sum(x) ** 2


def squared(x, y) -> int:
    return sum((a - b) ** 2 for a, b in zip(x, y))


class Search:
    """Nearest centroid of many vectors; ties go to the smaller number."""

    def __init__(self, centroids: list[tuple[int, ...]]):
        self.size = len(centroids[0]) if centroids else 0
        order = sorted(range(len(centroids)), key=lambda j: (sum(centroids[j]), j))
        self.number = np.array(order, dtype=np.int64)
        self.centroids = [centroids[j] for j in order]
        self.sums = [sum(c) for c in self.centroids]
        self.spreads = [spread(c) for c in self.centroids]
        # capped, so that bounds stay finite (a smaller bound rejects less)
        self.sum_f = np.array([float(max(-_CAP, min(_CAP, s))) for s in self.sums])
        self.dev_f = np.array([math.sqrt(min(_CAP, s) / max(self.size, 1)) for s in self.spreads])
        self.medium = np.array([all(abs(v) < MEDIUM for v in c) for c in self.centroids], dtype=bool)
        self.table = np.array([c if m else (0,) * self.size for c, m in zip(self.centroids, self.medium)],
                              dtype=np.int64).reshape(len(order), self.size)
        self.computed = 0                    # exact distances

    def one(self, x: list[int]) -> tuple[int, int]:
        """(centroid, distance) of any integer vector, with integers of any length."""
        k, total, own = self.size, sum(x), math.isqrt(spread(x))
        right = bisect.bisect_left(self.sums, total)
        left, best = right - 1, None
        while left >= 0 or right < len(self.sums):
            lower = right >= len(self.sums) or (left >= 0 and abs(total - self.sums[left]) <= abs(total - self.sums[right]))
            j = left if lower else right
            left, right = (left - 1, right) if lower else (left, right + 1)
            apart = (total - self.sums[j]) ** 2              # k times the first part of the bound
            if best is not None and apart > k * best[0]:
                break
            gap = max(0, abs(own - math.isqrt(self.spreads[j])) - 1)
            if best is None or apart + gap * gap <= k * best[0]:
                self.computed += 1
                best = min(best or (math.inf, 0), (squared(x, self.centroids[j]), int(self.number[j])))
        return best[1], best[0]

    def many(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(centroid, distance, whether found) of int64 rows with components below
        ``SMALL``; a row is not found if a centroid of larger numbers may be the nearest."""
        n, k, count = len(x), self.size, len(self.sums)
        total = x.sum(axis=1)
        dev = np.sqrt((k * (x * x).sum(axis=1) - total * total) / k)
        best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, count, dtype=np.int64)
        found = np.ones(n, dtype=bool)
        right = np.searchsorted(self.sum_f, total.astype(np.float64))
        left = right - 1
        go = np.arange(n)
        while len(go):
            at = total[go].astype(np.float64)
            gap_l = np.where(left[go] >= 0, np.abs(at - self.sum_f[np.maximum(left[go], 0)]), np.inf)
            gap_r = np.where(right[go] < count, np.abs(at - self.sum_f[np.minimum(right[go], count - 1)]), np.inf)
            lower = gap_l <= gap_r
            gap, j = np.where(lower, gap_l, gap_r), np.where(lower, left[go], right[go])
            by_mean = gap * gap / k * (1 - _MARGIN)
            some = best[go].astype(np.float64)
            some[number[go] == count] = np.inf               # nothing computed yet
            on = np.isfinite(gap) & (by_mean <= some)
            go, j, by_mean, some, lower = go[on], j[on], by_mean[on], some[on], lower[on]
            left[go[lower]] -= 1
            right[go[~lower]] += 1
            off = np.maximum(0, np.abs(dev[go] - self.dev_f[j]) - _MARGIN * (dev[go] + self.dev_f[j]))
            near = by_mean + off * off * (1 - _MARGIN) <= some
            found[go[near & ~self.medium[j]]] = False
            near &= self.medium[j]
            row, c = go[near], j[near]
            gaps = x[row] - self.table[c]
            distance = (gaps * gaps).sum(axis=1)
            self.computed += len(row)
            better = (distance < best[row]) | ((distance == best[row]) & (self.number[c] < number[row]))
            best[row[better]], number[row[better]] = distance[better], self.number[c[better]]
            go = go[found[go]]
        return number, best, found


def _integers(column: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(components as doubles, rows that are small)."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return x, (np.abs(x) < (SMALL - 1) / scale).all(axis=1)


def _assigned(column: pa.Array, search: Search, size: int, scale: int):
    """Slices of (first row, small rows, their integers, other rows with theirs,
    centroid per row, distance per row or None)."""
    for lo in range(0, len(column), _ROWS):
        x, small = _integers(column.slice(lo, _ROWS), size, scale)
        where = np.flatnonzero(small)
        whole = np.floor(x[where] * scale).astype(np.int64)
        number = np.zeros(len(x), dtype=np.int64)
        number[where], best, found = search.many(whole)
        distance = [0] * len(x)
        for i, d in zip(where.tolist(), best.tolist()):
            distance[i] = d
        others = {i: [quantised(c, scale) for c in x[i].tolist()] for i in np.flatnonzero(~small).tolist()}
        for i in where[~found].tolist():
            number[i], distance[i] = search.one([quantised(c, scale) for c in x[i].tolist()])
        for i, v in others.items():
            number[i], distance[i] = search.one(v)
        yield lo, where, whole, others, number, distance


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, part): the value is the sum of part * 2^(60 place)."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value or not place:
        yield place, sign * (value & ((1 << _LIMB) - 1))
        value >>= _LIMB
        place += 1


def _moved(vectors: DataFrame, centroids: list[tuple[int, ...]], scale: int) -> list[tuple[int, ...]]:
    """The centroids after a round."""
    size = len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        sums = [[0] * size for _ in centroids]
        counts = np.zeros(len(centroids), dtype=np.int64)
        for b in batches:
            for _, where, whole, others, number, _ in _assigned(b.column(1), search, size, scale):
                counts += np.bincount(number, minlength=len(centroids))
                for c in np.unique(number[where]).tolist():
                    for i, s in enumerate(whole[number[where] == c].sum(axis=0).tolist()):
                        sums[c][i] += s
                for row, v in others.items():
                    own = sums[number[row]]
                    for i, s in enumerate(v):
                        own[i] += s
        out = [(c, -1, 0, int(n)) for c, n in enumerate(counts) if n]
        out += [(c, i, place, part) for c, n in enumerate(counts) if n
                for i, s in enumerate(sums[c]) for place, part in _limbs(s)]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(
            zip(*out) if out else ([],) * 4, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
            names=["cluster", "component", "place", "part"])

    added = (map_batches(vectors, run, "cluster int, component int, place int, part long")
             .groupBy("cluster", "component", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")))
    total: dict[tuple[int, int], int] = {}
    for r in added.collect():                        # k * (size + 1) numbers, of a few limbs
        key = (r["cluster"], r["component"])
        total[key] = total.get(key, 0) + (int(r["part"]) << (_LIMB * r["place"]))
    return [tuple(total[c, i] // total[c, -1] for i in range(size)) if (c, -1) in total else old
            for c, old in enumerate(centroids)]


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024,
                    seed: str = "3") -> DataFrame:
    """``(vec_id, embedding)`` -> ``(vec_id, cluster, distance, cluster_inertia, inertia,
    centroid)``, a row per kept vector.

    The centroids start as the k kept vectors with the smallest sha256 of
    ``seed:vec_id``.  Each round assigns all vectors and replaces every non-empty
    centroid by the floor of its vectors' mean; then vectors are assigned once more.
    distance is squared; cluster_inertia and inertia sum it over the cluster and over
    all; centroid is the cluster's final one, its components joined by commas."""
    x = F.col("embedding")
    number = F.col("embedding").cast("array<double>")
    kept = vectors.select("vec_id", x).filter(
        x.isNotNull() & (F.size(x) == size)
        & F.forall(number, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    if vectors.schema["embedding"].dataType.simpleString() != "array<float>":
        kept = kept.withColumn("embedding", number)
    kept = materialise(kept, "vectors")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.orderBy(drawn, "embedding").limit(k).collect()          # k rows
    centroids = [tuple(quantised(float(c), scale) for c in r["embedding"]) for r in first]
    for _ in range(rounds if centroids else 0):
        centroids = _moved(kept, centroids, scale)
    fits = 1 << 63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for b in batches:
            for lo, _, _, _, number, distance in _assigned(b.column(1), search, size, scale):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(number)), pa.array(number.astype(np.int32)),
                     pa.array([d if d < fits else None for d in distance], pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    placed = materialise(map_batches(kept, run, f"vec_id {id_type}, cluster int, distance long"), "placed")
    added = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"),
                                          F.count_if(F.col("distance").isNull()).alias("beyond")).collect()
    whole = None if any(r["beyond"] for r in added) else sum(int(r["total"]) for r in added)
    own = {r["cluster"]: None if r["beyond"] else int(r["total"]) for r in added}
    fitting = lambda v: v if v is not None and v < fits else None
    # k rows
    facts = vectors.sparkSession.createDataFrame(
        [(c, fitting(own.get(c)), fitting(whole), ",".join(map(str, v))) for c, v in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid string")
    return placed.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
