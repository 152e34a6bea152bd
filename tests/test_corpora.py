"""Split descriptions, stored annotation tables, vector sums in blocks and component streams."""

import os
import re

import numpy as np
from pyspark.sql import functions as F

from spanforge.operators import lexicon, metrics, pipeline, similarity, tokens
from spanforge.sources import sinks
from spanforge.streaming.corpus_stream import start_component_stream


def test_describe_splits_within_the_stated_errors(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 == 0, "test").otherwise("train").alias("split"),
        F.when(F.col("id") % 7 != 0, F.repeat(F.lit("x"), (F.col("id") % 300).cast("int"))).alias("text"),
        F.sequence(F.lit(1), (F.col("id") % 5 + 1).cast("int")).alias("tags"), (F.col("id") % 4000).alias("n"))
    got = {(r["split"], r["name"]): r for r in lexicon.describe_splits(
        df, {"text": F.col("text"), "tags": F.col("tags"), "n": F.col("n")}, edges=(1, 50, 200), accuracy=100).collect()}
    assert len(got) == 6
    rows = df.collect()
    for (split, name), r in got.items():
        kept = [x[name] for x in rows if x["split"] == split]
        size = sorted(x if name == "n" else len(x) for x in kept if x is not None)
        assert (r["n_rows"], r["n_null"]) == (len(kept), len(kept) - len(size))
        assert (r["minimum"], r["maximum"]) == (size[0], size[-1]) and abs(r["mean"] - np.mean(size)) < 1e-6
        for p, value in ((0.5, r["median"]), (0.9, r["p90"])):
            low, high = np.searchsorted(size, value, "left"), np.searchsorted(size, value, "right")
            assert low - len(size) / 100 - 1 <= p * len(size) <= high + len(size) / 100 + 1
        assert r["histogram"] == [int(x) for x in np.histogram(size, [-1, 1, 50, 200, 10 ** 9])[0]]
        exact = len({tuple(x) if isinstance(x, list) else x for x in kept if x is not None})
        assert abs(r["n_distinct"] - exact) <= 4 * 0.02 * exact + 1


def test_describe_nulls_and_empty_frames(spark):
    schema = "split string, text string"
    r, = lexicon.describe_splits(spark.createDataFrame([(None, None), (None, None)], schema), {"text": F.col("text")}).collect()
    assert (r["split"], r["n_rows"], r["n_null"], r["median"], r["n_distinct"]) == (None, 2, 2, None, 0)
    assert r["histogram"] == [0] * 6
    assert lexicon.describe_splits(spark.createDataFrame([], schema), {"text": F.col("text")}).collect() == []


def test_stored_annotation_tables_are_scored_without_a_shuffle(spark):
    chunk = "array<struct<type:string,first:int,last:int>>"
    gold = spark.createDataFrame([(k, [("Dosis", 0, k % 3)]) for k in range(500)], f"k long, g {chunk}")
    pred = spark.createDataFrame([(k, [("Dosis", 0, 1)]) for k in range(100, 600)], f"k long, p {chunk}")
    stored = []
    for name, df in (("gold", gold), ("pred", pred)):
        path = sinks.scratch_path(spark, name)
        stored.append(sinks.write_bucketed(df, os.path.basename(path).replace("-", "_"), path, "k", 4))
        assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 4
    out = metrics.ner_prf_tables(*stored, "k", "g", "p")
    rows = {r["scope"]: r for r in out.collect()}
    tp = sum(k % 3 == 1 for k in range(100, 500))
    assert (rows["overall"]["n_gold"], rows["overall"]["n_pred"], rows["overall"]["tp"]) == (500, 500, tp)
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # the one exchange lies above the join: the rollup's
    assert len(re.findall(r"\bExchange\b", plan)) == 1 and plan.index("Exchange") < plan.index("SortMergeJoin")


def test_mean_vector_in_blocks_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = {k: [float(x) for x in rng.normal(size=n)] for k, n in enumerate([10, 10, 7, 1, 16, 0])}
    vectors[6] = None
    vectors[7] = [1.0, None, 2.0]
    rows = [("a", int(k)) for k in rng.integers(0, 8, 60)] + [("b", 3), ("b", 3), ("c", 5), ("d", 6), ("e", 7), ("f", 99)]
    r = spark.createDataFrame(rows, "doc string, vec_id long")
    v = spark.createDataFrame(list(vectors.items()), "vec_id long, emb array<double>")
    for block in (3, 4, 64):
        got = {x["doc"]: x for x in similarity.mean_vector(r, ["doc"], "vec_id", v, "emb", block).collect()}
        assert set(got) == {"a", "b", "c", "e"}          # only null or no vectors: no row
        for doc, x in got.items():
            used = [vectors[k] for d, k in rows if d == doc and vectors.get(k) is not None]
            full = np.zeros((len(used), max(map(len, used))))
            for i, e in enumerate(used):
                full[i, :len(e)] = [0.0 if y is None else y for y in e]
            assert x["n_vectors"] == len(used) and len(x["mean_vec"]) == full.shape[1]
            assert np.allclose(x["mean_vec"], full.mean(axis=0))


def test_component_stream_goes_on_after_a_restart(spark):
    src, out = sinks.scratch_path(spark, "texts"), sinks.scratch_path(spark, "out")
    chain = pipeline.Pipeline().add("tokenize", tokens.tokenize)
    chain.add("length", lambda df: df.withColumn("n_tokens", F.size("tokens")))
    texts = [(k, "ein Satz mit Wort " * (k % 4)) for k in range(40)]
    df = spark.createDataFrame(texts, "sent_id long, sentence string")

    def run():
        q = start_component_stream(spark, chain, src, "sent_id long, sentence string", out,
                                   name=os.path.basename(out), columns=["sent_id", "n_tokens"])
        q.awaitTermination()
        return sum(p["numInputRows"] for p in q.recentProgress)

    df.where("sent_id < 25").write.json(src)
    assert run() == 25
    assert run() == 0                                       # nothing new: nothing is read again
    df.where("sent_id >= 25").write.mode("append").json(src)
    assert run() == 15
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert got == sorted(map(tuple, chain(df).select("sent_id", "n_tokens").collect()))
