"""Lattice hashing, connected components, the pipeline and the registered queries."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.llm import lattice
from spanforge.llm.components import connected_components


def test_components_of_a_chain_a_star_and_loops(spark):
    rnd = random.Random(1)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 100 + i) for i in range(1, 80)]
    edges = [(b, a) if rnd.random() < 0.5 else (a, b) for a, b in chain + star] + [(300, 300), (5, 4), (5, 4)]
    rnd.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(80)}, 300: 300}
    none = spark.createDataFrame([], "src long, dst long")
    assert connected_components(none).count() == 0


def test_nearest_lattice_point():
    rnd = np.random.default_rng(0)
    assert len(lattice.SHORTEST) == 240 and np.allclose((lattice.SHORTEST ** 2).sum(1), 2)
    x = rnd.normal(size=(300, 8)) * 2
    p = lattice.nearest(x)
    whole = np.isclose(p, np.rint(p)).all(1) | np.isclose(p - 0.5, np.rint(p - 0.5)).all(1)
    assert whole.all() and np.allclose(p.sum(1) % 2, 0)
    gap = ((x - p) ** 2).sum(1)
    assert all((gap <= ((x - p - v) ** 2).sum(1) + 1e-9).all() for v in lattice.SHORTEST)


def brute(rows, threshold):
    def fine(x):
        return x is not None and all(c is not None and np.isfinite(c) for c in x) and any(x)
    def direction(x):
        y = np.array(x) / np.abs(x).max()                    # no overflow
        return y / np.linalg.norm(y)
    unit = [direction(x) if fine(x) and l is not None else None for _, x, l in rows]
    n = len(rows)
    links = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None
              and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, stack = {i}, [i]
        while stack:
            for j in links[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        out.append((rows[i][0], len(links[i]), min(rows[j][0] for j in seen)))
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    rnd = np.random.default_rng(5)
    rows = []
    for i in range(300):
        x = rnd.normal(size=64)
        rows.append((i, x.tolist(), i % 3))
        for j in range(3):
            y = x / np.linalg.norm(x) + rnd.normal(size=64) * rnd.choice([0.01, 0.03, 0.045])
            rows.append((1000 + 3 * i + j, y.tolist(), i % 3 if j else (i + 1) % 3))
    nan, inf = float("nan"), float("inf")
    rows += [(5000, rows[0][1], 0), (5001, rows[0][1], 0), (5002, rows[0][1], None), (5003, None, 1), (5004, [0.0] * 64, 1),
             (5005, [nan] + [1.0] * 63, 1), (5006, [inf] + [1.0] * 63, 1), (5007, [None] + [1.0] * 63, 1), (5008, [], 1),
             (5009, [1.0, 0.0], 1), (5010, [1.0, -0.0], 1), (5011, [1e200] * 64, 2), (5012, [1.0] * 64, 2)]
    return rows


def test_recall_against_brute_force(spark, vectors):
    schema = "vec_id long, embedding array<double>, label int"
    rows = vectors
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in lattice.near_vectors(
        spark.createDataFrame(rows, schema).withColumn("node", F.lit(1)), 0.93).collect())
    want = brute(rows, 0.93)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.95 * sum(w[1] for w in want)
    assert sum(g == w for g, w in zip(got, want)) >= 0.9 * len(want)
    empty = spark.createDataFrame([], schema)
    assert lattice.near_vectors(empty).count() == 0


def test_no_link_below_the_threshold_at_any_size(spark):
    rnd = np.random.default_rng(9)
    rows = []
    for i in range(30):
        x, y = rnd.normal(size=64), rnd.normal(size=64)
        x /= np.linalg.norm(x)
        y -= (y @ x) * x
        y = 0.85 * x + np.sqrt(1 - 0.85 ** 2) * y / np.linalg.norm(y)
        for scale in (1.0, 1e200, 1e-200):
            rows += [(len(rows), (x * scale).tolist(), i), (len(rows) + 1, (y * scale).tolist(), i)]
    got = lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 0.93).collect()
    assert all(r.n_links == 2 and r.component_id // 6 == r.vec_id // 6 and (r.component_id - r.vec_id) % 2 == 0 for r in got)


def test_registered_queries_and_pipeline(spark, sf):
    import __spark_entry__ as entry
    import corpus_pipeline
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "substring", "pii", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = corpus_pipeline.materialise(stage(spark, docs, sf), name)
        if name != "packing":
            assert docs.columns == columns and 0.7 * before <= docs.count() <= before
    assert docs.select("doc_id").distinct().count() == before


@pytest.mark.parametrize("name", ["op6_substring_dedup", "op7_embedding_lattice"])
def test_queries_against_sql(spark, sf, name):
    import duckdb

    import __spark_entry__ as entry
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = entry.queries()[name](spark, sf).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    columns, key = sorted(got.columns), got.columns[0]
    assert sorted(want.columns) == columns
    a, b = (x[columns].sort_values(key).astype(str).reset_index(drop=True) for x in (got, want))
    assert a.equals(b)


def test_stages_on_odd_rows(spark, sf, odd):
    import corpus_pipeline
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        got = corpus_pipeline.materialise(stage(spark, docs, sf), name)
        if name != "packing":
            assert got.columns == odd.columns
            # both rows without a doc_id are copies of rows with one
            assert got.filter("doc_id is null").count() == (2 if name == "toxicity" else 0)
            assert stage(spark, odd.limit(0), sf).count() == 0
        docs = got
    assert {r.doc_id for r in docs.collect()} >= {1, 7, 8, 9, 10, 11, 13, 14}
