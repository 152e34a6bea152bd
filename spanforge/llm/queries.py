"""The registered queries: each applies one operator to its whole table and
derives the digest columns from the operator's real output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SUBSTRING_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (
  SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, ws FROM d WHERE len(ws) >= 35),
w AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY array_to_string(ws[i:i + 34], ' ')) AS n FROM p),
g AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM w WHERE n > 1),
u AS (
  SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM d),
s AS (
  SELECT u.doc_id, string_agg(u.x, ' ' ORDER BY u.i) AS kept, count(*) AS n
  FROM u LEFT JOIN g ON g.doc_id = u.doc_id AND g.i = u.i WHERE g.i IS NULL GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""


def _part(n: int):
    """crc32 of the doc_id as text, modulo n (null: as the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score
    labels = _table(spark, sf_dir, "labels").filter(_part(5) != 0)
    return score(_table(spark, sf_dir, "documents"), labels).select(
        "doc_id", (_part(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import KINDS, spans
    found = spans(_table(spark, sf_dir, "documents"))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"),
        F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"]).alias("said")))
    terms = F.transform("terms", lambda t: F.struct(
        t["start"].alias("start"), F.lit(len(KINDS)).alias("kind"),
        F.concat_ws(":", F.lit("term"), t["start"], t["end"]).alias("said")))
    said = lambda a: F.array_join(F.transform(F.array_sort(a), lambda s: s["said"]), ",")
    return found.select(
        "doc_id", *[F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as bigint)").alias(f"n_{name}")
                    for k, name in enumerate(KINDS)],
        F.sha2(said(base), 256).alias("base_sha256"), said(F.concat(base, terms)).alias("spans"))


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import decode, encode
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern).drop("text")
    return decode(encoded, path, pattern).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import predict, train
    docs = _table(spark, sf_dir, "documents")
    names, trees = train(docs.filter(_part(4) != 2), order=3, per_language=2000)
    return predict(docs, names, trees, order=3).select("doc_id", (_part(4) == 2).alias("held_out"), "lang_pred", "score")


@query("op6_substring_dedup", _SUBSTRING_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import repeats
    return repeats(_table(spark, sf_dir, "documents"), length=35).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_EMBEDDING_SQL = """
WITH RECURSIVE e AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
g AS (
  SELECT *, sqrt(list_sum(list_transform(x, lambda c: c * c))) AS norm FROM e
  WHERE label IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
l AS (
  SELECT a.r AS a, b.r AS b FROM g a JOIN g b
  ON a.label = b.label AND a.r <> b.r AND a.norm > 0 AND b.norm > 0 AND len(a.x) = len(b.x)
  AND list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) / (a.norm * b.norm) >= 0.93),
c AS (
  SELECT r AS root, r AS node FROM e
  UNION
  SELECT c.root, l.b FROM c JOIN l ON l.a = c.node),
m AS (
  SELECT c.node AS r, min(e.vec_id) AS component_id FROM c JOIN e ON e.r = c.root GROUP BY c.node),
n AS (
  SELECT a AS r, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, m.component_id, e.vec_id = m.component_id AS kept
FROM e JOIN m USING (r) LEFT JOIN n USING (r)
"""


@query("op7_embedding_lattice", _EMBEDDING_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lattice import near_vectors
    return near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.93).withColumn(
        "kept", F.col("vec_id") == F.col("component_id"))


@query("op8_token_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .rans import read_tokens, write_tokens
    from .scratch import scratch_path
    path = scratch_path(spark, "token-files")
    write_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path, end_id=0)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge
    return judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


@query("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates
    found = near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _clustering_sql(k: int = 8, rounds: int = 10) -> str:
    """Vectors as (row, component, value) rows, centroids as (number, component, value)
    rows, a pair of steps per round."""
    steps = [f"""
e AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), embedding) AS r, vec_id,
         list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS MATERIALIZED (SELECT r, unnest(x) AS val, generate_subscripts(x, 1) AS i FROM e),
c0 AS MATERIALIZED (SELECT r - 1 AS c, i, val FROM v WHERE r <= {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT r, c, d FROM (
    SELECT r, c, sum((v.val - k.val) * (v.val - k.val)) AS d FROM v JOIN c{n} k USING (i) GROUP BY r, c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if n < rounds:
            steps.append(f"""
m{n} AS (SELECT c, i, sum(val) AS s, count(*) AS n FROM v JOIN a{n} USING (r) GROUP BY c, i),
c{n + 1} AS MATERIALIZED (
  SELECT c, i, CAST(coalesce((s - ((s % n) + n) % n) / n, val) AS BIGINT) AS val
  FROM c{n} LEFT JOIN (SELECT c, i, CAST(s AS HUGEINT) AS s, n FROM m{n}) USING (c, i))""")
    return f"""WITH {",".join(steps)},
h AS (SELECT c, sha256(string_agg(CAST(val AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       centroid_sha256 FROM a{rounds} JOIN e USING (r) JOIN h USING (c)"""


@query("op11_centroids", _clustering_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroids import cluster_vectors
    found = cluster_vectors(_table(spark, sf_dir, "embeddings"), k=8, rounds=10, size=64, scale=1024, seed="3")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2("centroid", 256).alias("centroid_sha256"))


@query("op12_lm_scoring")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ctw import score
    found = score(_table(spark, sf_dir, "documents"), _part(5) != 1)
    return found.select("doc_id", (_part(5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                        "score")


_MIDDLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
w AS (
  SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS one,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS two FROM d),
c AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                      OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 100 THEN 'plain'
                 WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1:least(one, two)], '') AS p,
         array_to_string(u[least(one, two) + 1:greatest(one, two)], '') AS m,
         array_to_string(u[greatest(one, two) + 1:], '') AS s FROM w)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM c
"""


@query("op13_fill_in_middle", _MIDDLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fim import fill_in_middle, restore
    made = fill_in_middle(_table(spark, sf_dir, "documents"), unit="line", seed="7", rate=100, spm=50)
    return restore(made).select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                                F.sha2("output", 256).alias("output_sha256"),
                                F.sha2("restored", 256).alias("restored_sha256"))
