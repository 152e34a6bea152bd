"""Plans that must not depend on a table being small: no broadcast by file statistics, no
hot key, no vector carried where its sums do."""

import pytest
from pyspark.sql import functions as F


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def shop(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(k,) for k in [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10, 10, None, None]], "o_orderkey long") \
        .write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(k, f"name {k % 5}", f"TYPE {k}", k) for k in range(1, 21)],
                          "p_partkey long, p_name string, p_type string, p_size int").write.parquet(f"{d}/part.parquet")
    spark.createDataFrame([(k, f"NATION {k}") for k in range(3)], "n_nationkey int, n_name string") \
        .write.parquet(f"{d}/nation.parquet")
    return d


def test_lexicon_lookups_are_one_merge_join(spark, shop):
    from spanforge.functions.hashing import draw_index
    from spanforge.operators import sampling
    from spanforge.plans import generation as G
    e = G.entity_rows(spark, shop)
    plan = plan_of(e)
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 1
    lex = {}
    for x in G.lexicon(spark, shop).collect():
        lex.setdefault((x.source, x.label), {})[x.idx] = x.term
    rows = e.collect()
    assert sorted(str(x.row_id) for x in rows) == sorted(str(k) for k in [*range(1, 10), 10, 10, 10, None, None])
    r = F.col("row_id")
    drawn = G.gen_rows(spark, shop).distinct().select(
        "row_id", sampling.shape_of(G.SEED, r).alias("shape"),
        *[draw_index(20 if salt == "med" else 3, G.SEED, r, F.lit(slot), salt).alias(f"{salt}{slot}")
          for slot in range(4) for salt in ("med", "diag")])
    want = {x.row_id: x for x in drawn.collect()}
    for x in rows:
        assert [y.label for y in x.entities] == want[x.row_id]["shape"]
        for slot, y in enumerate(x.entities):
            if y.label == "Medikation":
                assert y.text == lex["curated", "Medikation"][want[x.row_id][f"med{slot}"]]
            elif y.label == "Diagnose":
                assert y.text == lex["code_list", "Diagnose"][want[x.row_id][f"diag{slot}"]]
            else:
                assert "type" in y.text


def test_mean_vector_shuffles_no_sums(spark):
    from spanforge.operators import similarity
    rows = spark.createDataFrame([(k % 3 if k % 7 else None, k % 5) for k in range(40)], "sent_id long, vec_id long")
    vectors = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(4)] + [(3, [30.0])], "vec_id long, emb array<float>")
    m = similarity.mean_vector(rows, ["sent_id"], "vec_id", vectors, "emb", rows_at_once=2)     # several groups
    assert "partial_sum" not in plan_of(m)
    want = {}
    for x in rows.collect():
        for v in vectors.collect():
            if v.vec_id == x.vec_id:
                want.setdefault(x.sent_id, []).append([*v.emb, 0.0][:2])
    got = {x.sent_id: (x.n_vectors, x.mean_vec) for x in m.collect()}
    assert got.keys() == want.keys()
    for key, vs in want.items():
        assert got[key] == (len(vs), pytest.approx([sum(e) / len(vs) for e in zip(*vs)]))


def test_token_offsets_are_made_by_batch(spark):
    import re

    from spanforge.operators import tokens
    texts = [None, "", " ", "ab, c", " \U0001f600 x\n\ty ", "é" * 50 + " z", None, "."]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, sentence string").coalesce(1)
    t = tokens.tokenize(df)
    assert "ArrowEvalPython" in plan_of(t) and "aggregate(" not in plan_of(t)
    for x in t.collect():
        want = None if x.sentence is None else [
            (i, p.group(), p.start(), p.end(), x.sentence[p.end():p.end() + 1].isspace())
            for i, p in enumerate(re.finditer(r"\w+|[^\w\s]", x.sentence))]
        assert (x.tokens and [tuple(y) for y in x.tokens]) == (want or x.tokens) and (x.tokens is None) == (want is None)


def test_corpus_is_written_without_a_sort(spark, tmp_path):
    from spanforge.sources import sinks
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before, during = spark.conf.get(key), []

    class Written:
        sparkSession = spark
        write = property(lambda self: self)

        def mode(self, how):
            return self
        partitionBy = mode

        def parquet(self, path):
            during.append(int(spark.conf.get(key)))
    sinks.write_corpus(Written(), str(tmp_path / "none"))
    assert during[0] >= 3 and spark.conf.get(key) == before
    path = str(tmp_path / "corpus")
    sinks.write_corpus(spark.range(30).selectExpr("id", "concat('s', id % 12) AS split"), path)   # more than are kept open
    assert sorted((x.id, x.split) for x in spark.read.parquet(path).collect()) == sorted((k, f"s{k % 12}") for k in range(30))


def test_vector_lookup_sums_a_vector_once(spark, tmp_path):
    import __spark_entry__ as entry
    spark.createDataFrame([(1, "a b a"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, [1.0, 2.5]), (1, None)], "vec_id long, embedding array<float>").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    v = entry.queries()["vector_lookup"](spark, str(tmp_path))
    plan = v._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("aggregate(") > plan.index("Join")
    assert all((x.v0, x.total) == ((1.0, 3.5) if x.vec_id == 0 else (None, None)) for x in v.collect())


def test_draws_of_a_batch_equal_the_expression(spark):
    from spanforge.functions.hashing import unit_draw, unit_draws
    rows = [(0, "7", list(range(120))), (1, None, [1, 2]), (2, "k" * 70, [5] * 11), (3, "", []), (4, "x", None), (5, "é", [0] * 1001)]
    df = spark.createDataFrame(rows, "k int, key string, over array<int>").coalesce(1)
    made = df.select("k", unit_draws(F.col("over"), 3, 42, F.col("key"), "logit").alias("u"))
    assert "ArrowEvalPython" in plan_of(made) and "md5" not in plan_of(made)
    want = df.select("k", F.transform("over", lambda _, p: F.transform(
        F.sequence(F.lit(0), F.lit(2)), lambda c: unit_draw(42, F.col("key"), p, c, "logit"))).alias("u"))
    assert {x.k: x.u for x in made.collect()} == {x.k: x.u for x in want.collect()}


def test_argmax_of_a_batch(spark):
    from spanforge.operators import bio
    nan = float("nan")
    rows = [[[0.5, 2.0, 2.0], [-1.0, -2.0, -3.0]], [[1.0, nan, nan]], [], None, [[0.0, -0.0], [None, 3.0], None, [], [None]]]
    df = spark.createDataFrame(list(enumerate(rows)), "k int, s array<array<double>>").coalesce(1)
    got = df.select("k", bio.argmax_rows(F.col("s")).alias("a"), F.transform("s", bio.argmax).alias("b"))
    assert "ArrowEvalPython" in plan_of(got) and all(x.a == x.b for x in got.collect())
    full = got.where(F.col("k") < 1)                       # scores of one width, without nulls
    assert full.first().a == [1, 0]
    words = spark.createDataFrame([([["b", "c", "a"], [None, "a"]],)], "s array<array<string>>")
    assert words.select(bio.argmax_rows(F.col("s"))).first()[0] == [1, 1]


def test_labels_of_a_batch(spark):
    """Nulls, rows next to each other and a long entity; no walk over a row's tokens."""
    from spanforge.operators import bio
    rows = [([(0, 3), (4, 9)], [(0, 9, 0)]), ([(0, 3), (4, 9)], []), (None, [(0, 3, 1)]), ([(0, 3)], None),
            ([(0, 0), (0, 3), (3, 4), (0, 0)], [(0, 4, None), (None, 9, 1), (0, None, 2), None]),
            ([(2 * i, 2 * i + 1) for i in range(1000)], [(10, 1501, 2), (0, 2000, 1)]), ([], [(0, 1, 0)])]
    df = spark.createDataFrame([(k, *x) for k, x in enumerate(rows)], "k int, o array<struct<start:int,stop:int>>, "
                               "e array<struct<start:int,stop:int,class_id:int>>").coalesce(1)
    labels = df.select("k", bio.token_labels(F.col("o"), F.col("e")).alias("l"))
    assert "ArrowEvalPython" in plan_of(labels) and "aggregate(" not in plan_of(labels)
    want = [[1, 2], [0, 0], None, None, [-100, -1, 0, -100], [3] + [4] * 4 + [5] + [6] * 745 + [4] * 249, []]
    assert [x.l for x in labels.orderBy("k").collect()] == want


def test_masked_and_counted_once(spark):
    from spanforge.operators import bio, metrics
    df = spark.createDataFrame([([1, 2, None, 3], [1, -100, 2, None]), ([1], [1, 0]), (None, [1]), ([], [])],
                               "p array<int>, g array<int>")
    m = df.select(bio.mask_ignored(F.col("p"), F.col("g")).alias("m"))
    assert plan_of(m).count("arrays_zip") == 1
    assert [x.m and (x.m.pred, x.m.gold) for x in m.collect()][:2] == [([1, None], [1, 2]), ([1, None], [1, 0])]
    assert tuple(metrics.token_accuracy(df, "p", "g").first())[:2] == (4, 2)


def test_answered_prompts_are_read_once(spark, tmp_path):
    """A second run makes the prompts once, for their keys; repeated prompts are asked once."""
    from spanforge.operators.responses import llm_map_once
    made = spark.sparkContext.accumulator(0)
    texts = ["a", "b", "a", None, None, "", "c", "a"]

    @F.udf("string")
    def prompt(k):
        made.add(1)
        return texts[k % 8] and f"{texts[k % 8]}{k // 24}"
    rows = spark.range(0, 120, 1, 4).select("id", prompt("id").alias("prompt"))

    def client(nobody):
        def make():
            if nobody:
                raise RuntimeError("every prompt is answered")
            return lambda p, system, attempt: f"{system}:{p}"
        return make
    ledger = str(tmp_path / "ledger")
    llm_map_once(rows, "prompt", client(False), ["id"], "s", ledger)
    asked = spark.read.parquet(ledger)
    assert asked.count() == asked.select("prompt_key").distinct().count() == 5 * 3 + 2
    made.value = 0
    got = llm_map_once(rows, "prompt", client(True), ["id"], "s", ledger).collect()
    assert made.value == 120
    want = [(k, "s:None" if texts[k % 8] is None else f"s:{texts[k % 8]}{k // 24}" if texts[k % 8] else "s:") for k in range(120)]
    assert sorted((x.id, x.raw) for x in got) == want
    more = rows.unionByName(spark.createDataFrame([(200, "new"), (201, "new")], "id long, prompt string"))
    assert llm_map_once(more, "prompt", client(False), ["id"], "s", ledger).count() == 122
    assert spark.read.parquet(ledger).count() == 5 * 3 + 3
    none = llm_map_once(rows.where("id < 0"), "prompt", client(True), ["id"], "s", str(tmp_path / "empty"))
    assert none.count() == 0


@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_mean_vector_writes_packed_counts(spark, monkeypatch, kind):
    """A row a key, not one a (key, vector): ids of any size, null keys, repeated ids."""
    from spanforge.operators import similarity
    ids = [0, 1, 127, 128, 300, 1 << 20, (1 << 31) - 1, -5] + ([1 << 62, -(1 << 62), -(1 << 63), (1 << 63) - 1] if kind == "long" else [])
    data = [(k % 5 or None, f"k{k % 2}", ids[k * k % len(ids)] if k % 11 else None) for k in range(400)]
    rows = spark.createDataFrame(data, "a int, b string, v long").withColumn("v", F.col("v").cast(kind)).coalesce(1)
    vectors = [(i, [float(n), None, 2.0][:n % 4]) for n, i in enumerate(ids)] + [(ids[1], [1.0, 2.0, 3.0, 4.0]), (ids[2], None), (99, [1.0])]
    table = spark.createDataFrame(vectors, "v long, e array<float>").withColumn("v", F.col("v").cast(kind))
    written = []
    monkeypatch.setattr(similarity, "write_scratch", lambda df, *how: written.append(df) or df)
    want = {}
    for a, b, i in data:
        for v, e in vectors:
            if v == i and e is not None:
                want.setdefault((a, b), []).append(e)
    assert len(want) == 10
    for at_once in (1 << 24, 7):
        got = similarity.mean_vector(rows, ["a", "b"], "v", table, "e", rows_at_once=at_once).collect()
        assert len(got) == len(want)
        for x in got:
            es = want[x.a, x.b]
            wide = max(map(len, es))
            mean = [sum((e[j] or 0.0) if j < len(e) else 0.0 for e in es) / len(es) for j in range(wide)]
            assert x.n_vectors == len(es) and x.mean_vec == pytest.approx(mean)
    assert [df.count() for df in written] == [10, 10]
    assert similarity.mean_vector(rows.where("a > 9"), ["a", "b"], "v", table, "e").count() == 0


def test_flips_and_chunks_of_a_batch(spark):
    from spanforge.functions.hashing import draw_index, unit_draw
    from spanforge.operators import bio, metrics
    from spanforge.plans import bindings as B
    rows = [(0, 7, [0, 1, 2, 0, 4, 3, 4, 6] * 30), (1, None, [2, 2, 1, None, 0]), (2, 5, []), (3, 6, None), (4, 8, [6]), (5, 9, [1]),
            (6, 10, [-100, 1, 2, -100]), (7, 11, [0, 9])]
    df = spark.createDataFrame(rows, "k int, key long, t array<int>").coalesce(1)
    flips = df.select("k", B.flip_tags(F.col("t"), F.col("key")).alias("t"))
    want = df.select("k", F.transform("t", lambda t, i: F.when(
        unit_draw(42, F.col("key"), i, "flip") < 0.1, draw_index(7, 42, F.col("key"), i, "tag")).otherwise(t)).alias("t"))
    assert "ArrowEvalPython" in plan_of(flips) and "md5" not in plan_of(flips)
    got = {x.k: x.t for x in flips.collect()}
    assert got == {x.k: x.t for x in want.collect()} and got[0] != rows[0][2]
    chunks = df.where("k > 0").select("k", bio.bio_chunks(F.col("t")).alias("c"))
    assert "ArrowEvalPython" in plan_of(chunks)
    m, d = "Medikation", "Diagnose"
    assert [[tuple(y) for y in x.c] for x in chunks.orderBy("k").collect()] == [
        [(m, 0, 1), (m, 2, 2)], [], [], [(d, 0, 0)], [(m, 0, 0)], [(None, 0, 0), (m, 1, 2), (None, 3, 3)], [(None, 1, 1)]]
    pairs = spark.createDataFrame([([(m, 0, 1), (m, 0, 1), (d, 3, 3), (None, 4, 4)], [(m, 0, 1), (d, 3, 4), (m, 3, 3)])],
                                  "g array<struct<type:string,first:int,last:int>>, p array<struct<type:string,first:int,last:int>>")
    counts = pairs.select(metrics.class_counts(F.col("g"), F.col("p"))).first()[0]
    assert {x.type: tuple(x)[1:] for x in counts} == {m: (2, 2, 1), "Dosis": (0, 0, 0), d: (1, 1, 0)}


def test_terms_are_looked_up_by_stretch(spark, tmp_path, monkeypatch):
    """The texts are cut once; a term's occurrences of a stretch are one row of the join."""
    import __spark_entry__ as entry
    from spanforge.operators import tokens
    from spanforge.plans import queries_eval
    texts = [(1, "a b a \u00e9\U0001f600"), (2, None), (3, ""), (None, "a b"), (1, "b, a\n\nc"), (4, "\t")]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted((str(x.sent_id), y.i, y.text) for x in queries_eval._toks(spark, str(tmp_path)).collect() for y in x.tokens)
    q = entry.queries()["term_lookup"](spark, str(tmp_path))
    assert "documents.parquet" not in plan_of(q) and "BroadcastHashJoin" not in plan_of(q)
    assert sorted((str(x.sent_id), x.i, x.token) for x in q.collect()) == want
    rows = spark.createDataFrame([(k, None if k % 9 == 0 else f"w{k % 4}") for k in range(90)], "k int, token string").coalesce(1)
    for at_once, n in ((1 << 20, 4), (30, 8)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "15")
        try:
            t = tokens.encoded(rows, ["k"], rows_at_once=at_once).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert len(t) == n
        assert sorted((k, x.term) for x in t for k in x.k) == sorted((x.k, x.token) for x in rows.collect() if x.token)
    term_id = F.conv(F.substring(F.md5("token"), 1, 15), 16, 10).cast("bigint")
    ids = {x.token: x.id for x in rows.where("token is not null").select("token", term_id.alias("id")).distinct().collect()}
    assert {x.term: x.term_id for x in t} == ids
