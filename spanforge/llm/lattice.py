"""Near-duplicate vectors by lattice hashing (operator 7).

A table projects each vector onto 8 random directions and decodes the point to the
nearest point of the E8 lattice; that lattice point is the vector's cell.  A vector
is stored in its own cell and looked up there and in the neighbouring cells nearest
to its projection (of the 240 shortest lattice vectors those that point its way).
Several tables are probed; pairs that meet are verified by their cosine in double
precision.

Equal vectors with equal labels are one node, so copies are never paired; a pair is
joined by cell, verified and counted once.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import connected_components
from .scratch import map_batches, materialise
from .wordarrays import mix64


def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [[s / 2 for s in signs] for signs in itertools.product((1, -1), repeat=8) if signs.count(-1) % 2 == 0]
    return np.array(out)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest point with integer coordinates of an even sum."""
    y = np.rint(x)
    odd = np.flatnonzero(y.sum(axis=1) % 2)
    gap = x[odd] - y[odd]
    worst = np.abs(gap).argmax(axis=1)
    step = np.where(gap[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    y[odd, worst] += step
    return y


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row: D8, or D8 moved by a half."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


def _directions(table: int, size: int) -> np.ndarray:
    """A table's 8 directions; the same in every task."""
    return np.random.default_rng(np.random.SeedSequence([8, table, size])).standard_normal((size, 8))


def _keys(points: np.ndarray) -> np.ndarray:
    """A hash per lattice point (coordinates are halves of integers)."""
    c = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    key = np.zeros(c.shape[:-1], dtype=np.uint64)
    for i in range(8):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + c[..., i] + np.uint64(i + 1))
    return key


def cells(x: np.ndarray, table: int, probes: int, scale: float) -> np.ndarray:
    """Keys of the cells to look in: the own one first, then the nearest neighbours."""
    y = x @ _directions(table, x.shape[1]) * scale
    own = nearest(y)
    if not probes:
        return _keys(own)[:, None]
    near = SHORTEST[np.argsort(-((y - own) @ SHORTEST.T), axis=1, kind="stable")[:, :probes]]
    return _keys(np.concatenate((own[:, None, :], own[:, None, :] + near), axis=1))


SHORTEST = shortest()


def near_vectors(vectors: DataFrame, threshold: float = 0.93, tables: int = 8, probes: int = 12,
                 scale: float = 1.25) -> DataFrame:
    """``(vec_id, embedding, label)`` -> ``(vec_id, n_links, component_id)``, a row per row.

    Vectors with equal non-null labels and a cosine of at least ``threshold`` that meet
    in some table are linked.  Equal vectors always are.  A null or zero vector, one
    with a null or non-finite component, or a null label, links with nothing and is
    its own component; vectors of different sizes don't link; component_id is the
    smallest vec_id reachable; rows that repeat a vec_id count as further vectors; other
    columns are ignored; an empty table gives an empty result.
    """
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x"), F.col("label").alias("label"))
    good = (F.col("label").isNotNull() & F.col("x").isNotNull()
            & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
            & F.exists("x", lambda c: c != 0))
    v = v.withColumn("good", F.coalesce(good, F.lit(False)))
    # one node for equal vectors with equal labels: + 0.0 makes -0.0 equal to 0.0
    x = F.transform("x", lambda c: c + F.lit(0.0))
    v = materialise(v.select("vec_id", "label", "good", F.when(F.col("good"), x).alias("x"),
                             F.when(F.col("good"), F.xxhash64("label", x)).alias("node"),
                             F.when(F.col("good"), F.hash("label", x)).alias("node2")), "vectors")
    nodes = (v.filter("good").groupBy("node", "node2").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"),
                                                          F.first("x").alias("x"), F.first("label").alias("label")))
    nodes = materialise(nodes.withColumn("node", F.xxhash64("node", "node2")).drop("node2"), "nodes")
    count = tables * (1 + probes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.diff(np.asarray(b.column(1).offsets))
            flat = np.asarray(b.column(1).flatten())
            starts = np.concatenate(([0], np.cumsum(size)))
            for n in np.unique(size).tolist():
                which = np.flatnonzero(size == n)
                for i in range(0, len(which), 1000):
                    part = which[i:i + 1000]
                    x = flat[starts[part][:, None] + np.arange(n)]
                    x = x / np.abs(x).max(axis=1, keepdims=True)      # no overflow
                    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                    keys = np.concatenate([mix64(cells(x, t, probes, scale) + np.uint64(t * 1_000_003 + n))
                                           for t in range(tables)], axis=1)
                    own = np.tile(np.arange(1 + probes) == 0, tables)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(np.repeat(part, count))),
                         b.column(2).take(pa.array(np.repeat(part, count))),
                         pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.tile(own, len(part)))],
                        names=["node", "label", "cell", "own"])

    placed = map_batches(nodes.select("node", "x", "label"), run, f"node long, label {vectors.schema['label'].dataType.simpleString()}, cell long, own boolean")
    placed = materialise(placed.withColumn("cell", F.xxhash64("cell", "label")).select("node", "cell", "own"), "cells")
    looked = placed.select(F.col("node").alias("a"), "cell")
    stored = placed.filter("own").select(F.col("node").alias("b"), "cell")
    met = (looked.join(stored, "cell").filter("a != b")
           .select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct())
    # divided by the largest component, so that no square overflows or vanishes
    scaled = nodes.select("node", "label", F.transform("x", lambda c: c / F.array_max(F.transform("x", F.abs))).alias("x"))
    unit = scaled.select("node", "x", "label", F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c)).alias("norm"))
    left, right = (unit.select(*[F.col(c).alias(f"{c}_{side}") for c in unit.columns]) for side in "ab")
    dot = F.aggregate(F.zip_with("x_a", "x_b", lambda p, q: p * q), F.lit(0.0), lambda s, c: s + c)
    links = materialise(
        met.join(left, met["src"] == left["node_a"]).join(right, F.col("dst") == right["node_b"])
        .filter((F.size("x_a") == F.size("x_b")) & F.col("label_a").eqNullSafe(F.col("label_b")))
        .filter(dot / (F.col("norm_a") * F.col("norm_b")) >= threshold).select("src", "dst"), "links")
    sized = nodes.select("node", "n")
    both = links.union(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    partners = (both.join(sized.withColumnRenamed("node", "dst"), "dst")
                .groupBy(F.col("src").alias("node")).agg(F.sum("n").alias("others")))
    groups = connected_components(links)
    named = (nodes.select("node", "low", "n").join(groups, "node", "left")
             .withColumn("root", F.coalesce("component", "node")))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    facts = (named.join(lowest, "root").join(partners, "node", "left")
             .select("node", "component_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    rows = v.select("vec_id", F.xxhash64("node", "node2").alias("node"), "good")
    return (rows.filter("good").join(facts, "node").select("vec_id", "n_links", "component_id")
            .unionByName(rows.filter("not good").select(
                "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))))
