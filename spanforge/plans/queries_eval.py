"""Registered queries: token patterns and gazetteer extras (H), similarity (I),
evaluation statistics (J), user functions (U)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from spanforge.functions.arrays import pin
from spanforge.functions.hashing import draw_index, unit_draws
from spanforge.operators import bio, metrics, pipeline, similarity, tokens
from spanforge.operators.matching import match_pattern, percentage_tokens
from spanforge.plans import bindings as B
from spanforge.plans import oracle as O
from spanforge.plans import scoring
from spanforge.plans.queries_corpus import joined
from spanforge.plans.queries_spans import _model_inputs, token_corpus
from spanforge.plans.registry import query
from spanforge.schemas import SEEDS_A
from spanforge.session import small_batches, table, write_scratch
from spanforge.sources import sinks

S = str(B.SEED)
_TOK = [O.SENTENCES, O.PIECES, O.TOKENS]


def _toks(spark, d):
    return scoring.tokenized_sentences(spark, d)


# --- H: patterns ---------------------------------------------------------------------

def pattern_sql(patterns) -> str:
    parts = []
    for a, (label, pat) in enumerate(patterns):
        L = len(pat)
        leads = ", ".join(["token AS t0"] + [f"lead(token, {k}) OVER w AS t{k}" for k in range(1, L)])
        conds = []
        for k, (attr, value) in enumerate(pat):
            t = f"t{k}"
            if attr == "TEXT":
                conds.append(f"{t} = {O.q(value)}")
            elif attr == "LOWER":
                conds.append(f"lower({t}) = {O.q(value)}")
            elif attr == "IS_DIGIT":
                conds.append(f"regexp_full_match({t}, '\\p{{Nd}}+')")
            elif attr == "LIKE_NUM":
                conds.append(f"regexp_full_match({t}, '[0-9]+([.,][0-9]+)*')")
        text = " || ' ' || ".join(f"t{k}" for k in range(L))
        parts.append(f"SELECT sent_id, {O.q(label)} AS label, {a} AS alt, i AS first_tok, i + {L} AS end_tok, "
                     f"{text} AS match_text FROM (SELECT sent_id, i, {leads} FROM tokens "
                     f"WINDOW w AS (PARTITION BY sent_id ORDER BY i)) WHERE {' AND '.join(conds)}")
    return "pm AS (" + " UNION ALL ".join(parts) + ")"


P_TEXT = [("OF_THE", [("TEXT", "of"), ("TEXT", "the")])]
P_DIGIT = [("NUMBER_PAIR", [("IS_DIGIT", None), ("TEXT", "-"), ("IS_DIGIT", None)])]
P_MIXED = [("SIZE", [("LOWER", "of"), ("LOWER", "the")]), ("SIZE", [("IS_DIGIT", None), ("TEXT", ")")])]
P_LOWER = [("GADGET", [("LOWER", "of"), ("LOWER", "the")]), ("GADGET", [("LOWER", "de"), ("LOWER", "la")])]


@query("percentage_tokens", lambda: O.with_(*_TOK) +
       ", tk AS (SELECT *, lead(token) OVER (PARTITION BY sent_id ORDER BY i) AS nxt FROM tokens) "
       "SELECT sent_id, i, token FROM tk WHERE nxt = '%' AND regexp_full_match(token, '[0-9]+([.,][0-9]+)*')")
def q_percentage(spark, d):
    """H1: number-like token followed by '%'."""
    return percentage_tokens(_toks(spark, d), ["sent_id"])


def _pat_query(patterns):
    def build(spark, d):
        return match_pattern(_toks(spark, d), ["sent_id"], patterns).select(
            "sent_id", "label", "alt", "first_tok", "end_tok", "match_text")
    return build


def _pat_sql(patterns):
    return lambda: O.with_(*_TOK, pattern_sql(patterns)) + \
        "SELECT sent_id, label, alt, first_tok::INTEGER AS first_tok, end_tok::INTEGER AS end_tok, match_text FROM pm"


query("match_text_pattern", _pat_sql(P_TEXT))(_pat_query(P_TEXT))
query("match_digit_pattern", _pat_sql(P_DIGIT))(_pat_query(P_DIGIT))
query("match_lower_alternatives", _pat_sql(P_LOWER))(_pat_query(P_LOWER))
query("match_mixed_alternatives", _pat_sql(P_MIXED))(_pat_query(P_MIXED))   # H4: LOWER or IS_DIGIT


@query("match_counts", lambda: O.with_(*_TOK, pattern_sql(P_LOWER)) +
       "SELECT label, alt, count(*)::BIGINT AS n FROM pm GROUP BY label, alt")
def match_counts(spark, d):
    """H5: number of matches per label and alternative."""
    return _pat_query(P_LOWER)(spark, d).groupBy("label", "alt").agg(F.count("*").alias("n"))


@query("overwrite_entities", lambda: O.with_(*O.scoring_ctes()[:7]) +
       "SELECT s.sent_id, count(f.first_tok)::INTEGER AS n_ents, coalesce(string_agg(f.first_tok || '-' || f.end_tok "
       "|| ':' || f.label, ';' ORDER BY f.first_tok), '') AS ents FROM sentences s LEFT JOIN filtered f USING (sent_id) "
       "GROUP BY s.sent_id")
def overwrite_entities(spark, d):
    """H7: a sentence's entities replaced by its (de-overlapped) matches."""
    g = scoring.gazetteer_entities(spark, d)
    e = F.transform("ents", lambda x: F.concat(x["first_tok"].cast("string"), F.lit("-"),
                                               x["end_tok"].cast("string"), F.lit(":"), x["label"]))
    return g.select("sent_id", F.size("ents").alias("n_ents"), F.array_join(e, ";").alias("ents"))


@query("term_dictionary", lambda: O.with_(*_TOK) +
       ", dct AS (SELECT token AS term, ('0x' || substr(md5(token), 1, 15))::BIGINT AS term_id, count(*)::BIGINT AS n "
       "FROM tokens GROUP BY token) SELECT term, term_id, n, "
       "(count(*) OVER (PARTITION BY term_id))::BIGINT AS ids_shared FROM dct")
def term_dictionary(spark, d):
    """H8: string <-> id dictionary with a stable hashed id and a collision
    check (``ids_shared`` must be 1)."""
    t = tokens.explode_tokens(_toks(spark, d), ["sent_id"])
    dct = t.groupBy(F.col("token").alias("term")).agg(F.count("*").alias("n"))
    dct = dct.withColumn("term_id", F.conv(F.substring(F.md5("term"), 1, 15), 16, 10).cast("bigint"))
    # collision check: terms per id (groups are single rows unless ids collide)
    from pyspark.sql import Window
    shared = F.count("*").over(Window.partitionBy("term_id"))
    return dct.select("term", "term_id", "n", shared.alias("ids_shared"))


@query("term_lookup", lambda: O.with_(*_TOK) +
       ", dct AS (SELECT DISTINCT token AS term, ('0x' || substr(md5(token), 1, 15))::BIGINT AS term_id FROM tokens) "
       "SELECT t.sent_id, t.i, dct.term AS token FROM tokens t JOIN dct ON dct.term_id = ('0x' || substr(md5(t.token), 1, 15))::BIGINT")
def term_lookup(spark, d):
    """H8 backwards: ids in, strings out, through the dictionary.  The texts are cut once:
    ids (occurrences by id) and dictionary are read from one written table."""
    t = write_scratch(tokens.encoded(tokens.explode_tokens(_toks(spark, d), ["sent_id"]), ["sent_id", "i"]), "encoded", "zstd")
    ids = t.select("term_id", "sent_id", "i")
    dct = t.select(F.col("term").alias("token"), "term_id").distinct()
    # merged, not broadcast: by its file statistics a well packed table looks small
    found = ids.hint("merge").join(dct, "term_id")
    return found.select("token", F.inline_outer(F.arrays_zip("sent_id", "i"))).select("sent_id", "i", "token")


_BENCH_KEYS = f"""bt AS (
  SELECT list_filter(regexp_extract_all(text, {O.q(O.TOKEN_PATTERN)}), lambda x: substr(x, 1, 1) NOT IN {O.BLANKS}) AS t
  FROM benchmark),
bk AS (SELECT DISTINCT key FROM (
  SELECT unnest(t) AS key FROM bt
  UNION ALL SELECT unnest(list_transform(range(1, len(t)), lambda k: t[k] || ' ' || t[k + 1])) FROM bt))"""


@query("phrase_match_large", lambda: O.with_(*_TOK, O.grams_cte(2), _BENCH_KEYS) +
       "SELECT sent_id, first_tok::INTEGER AS first_tok, end_tok::INTEGER AS end_tok, key FROM grams JOIN bk USING (key)")
def phrase_match_large(spark, d):
    """H6 with a gazetteer that grows with the tables: all distinct words and word pairs
    of the benchmark passages."""
    from spanforge.operators.matching import ngram_keys, phrase_match_join, token_counts
    b = tokens.tokenize(table(spark, d, "benchmark").select(F.col("text").alias("sentence")))
    lex = (b.select(F.inline_outer(ngram_keys(F.col("tokens"), [1, 2]))).where(F.col("key").isNotNull())
           .select("key", F.lit("Diagnose").alias("label")).distinct())
    m = phrase_match_join(_toks(spark, d), lex, ["sent_id"], counts=token_counts(B.sentences(spark, d)))
    return m.select("sent_id", "first_tok", "end_tok", "key")


# --- I: vectors ---------------------------------------------------------------------

def _tok_ids(spark, d):
    """Tokens with the id of their vector (hashed into the vector table)."""
    n = table(spark, d, "embeddings").count()  # vocabulary size of the vector table (plan constant)
    t = tokens.explode_tokens(_toks(spark, d), ["sent_id"])
    return t.withColumn("vec_id", draw_index(n, B.SEED, F.col("token"), "vec").cast("long"))


def _vec_sql():
    return O.with_(*_TOK) + (f", tv AS (SELECT t.sent_id, t.i, t.token, e.vec_id, e.embedding FROM tokens t "
                             f"JOIN embeddings e ON e.vec_id = {O.draw('(SELECT count(*) FROM embeddings)', S, 't.token', chr(39) + 'vec' + chr(39))}) ")


@query("vector_lookup", lambda: O.with_(*_TOK) +
       ", v AS (SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS v0, "
       "round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS total FROM embeddings), "
       "w AS (SELECT token, " + O.draw("n", S, "token", "'vec'") + " AS vec_id FROM "
       "(SELECT DISTINCT token FROM tokens), (SELECT count(*) AS n FROM embeddings)) "
       "SELECT sent_id, i, v.vec_id, v0, total FROM tokens JOIN w USING (token) JOIN v ON v.vec_id = w.vec_id")
def vector_lookup(spark, d):
    """Token -> vector (hashed vocabulary id into the vector table)."""
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))     # once a vector, not a token
    vectors = table(spark, d, "embeddings").select("vec_id", F.struct("embedding", total.alias("total")).alias("vec"))
    v = similarity.lookup_vectors(_tok_ids(spark, d), vectors, "vec_id", "vec_id", "vec")
    return v.select("sent_id", "i", "vec_id", F.get(F.col("vec.embedding"), 0).cast("double").alias("v0"), F.col("vec.total"))


def _dot_sql(a, b):
    return f"list_sum(list_transform(range(1, len({a}) + 1), lambda k: {a}[k]::DOUBLE * {b}[k]::DOUBLE))"


@query("cosine_pairs", lambda: "SELECT a.vec_id AS a, b.vec_id AS b, round(CASE WHEN "
       f"{_dot_sql('a.embedding', 'a.embedding')} = 0 OR {_dot_sql('b.embedding', 'b.embedding')} = 0 THEN 0.0 ELSE "
       f"{_dot_sql('a.embedding', 'b.embedding')} / (sqrt({_dot_sql('a.embedding', 'a.embedding')}) * "
       f"sqrt({_dot_sql('b.embedding', 'b.embedding')})) END, 6) AS cosine "
       "FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_pairs(spark, d):
    """Cosine similarity over a pair list (each vector with its successor id)."""
    emb = table(spark, d, "embeddings")
    pairs = emb.select(F.col("vec_id").alias("a"), (F.col("vec_id") + 1).alias("b"))
    return similarity.cosine_pairs(pairs, emb, "a", "b", "vec_id", "embedding").select("a", "b", "cosine")


@query("mean_vector", lambda: _vec_sql() +
       ", dims AS (SELECT sent_id, k, avg(embedding[k + 1]) AS m FROM (SELECT sent_id, embedding, "
       "unnest(range(len(embedding))) AS k FROM tv) GROUP BY sent_id, k) "
       ", cnt AS (SELECT sent_id, count(*)::BIGINT AS n_vectors FROM tv GROUP BY sent_id) "
       "SELECT sent_id, n_vectors, round(max(CASE WHEN k = 0 THEN m END), 6) AS m0, "
       "round(max(CASE WHEN k = 63 THEN m END), 6) AS m63, round(sqrt(sum(m * m)), 6) AS norm, "
       "string_agg(round(m * 1000000)::BIGINT::VARCHAR, ',' ORDER BY k) AS micro "
       "FROM dims JOIN cnt USING (sent_id) GROUP BY sent_id, n_vectors")
def mean_vector(spark, d):
    """Sentence vector = mean of its token vectors; ``micro`` holds all its elements
    in millionths."""
    m = similarity.mean_vector(_tok_ids(spark, d), ["sent_id"], "vec_id", table(spark, d, "embeddings"), "embedding")
    micro = F.transform("mean_vec", lambda x: F.round(x * 1000000).cast("long").cast("string"))
    return m.select("sent_id", "n_vectors", F.get(F.col("mean_vec"), 0).alias("m0"),
                    F.get(F.col("mean_vec"), 63).alias("m63"), similarity.norm(F.col("mean_vec")).alias("norm"),
                    F.array_join(micro, ",").alias("micro"))


# --- J: evaluation ---------------------------------------------------------------------

def _logits(seq_size, key):
    return unit_draws(F.sequence(F.lit(0), seq_size - 1), 7, B.SEED, key, "logit")


def _pred_gold(spark, d):
    small_batches(spark)                  # a token's scores are 14 times what is sent for it
    m = _model_inputs(spark, d, False)
    m = m.withColumn("pred", pin(bio.argmax_rows(_logits(F.size("seq"), F.col("sent_id")))))
    return m


_ARGMAX_SQL = (f", lg AS (SELECT q.sent_id, q.p, c.c, {O.unit(S, 'q.sent_id', 'q.p', 'c.c', chr(39) + 'logit' + chr(39))} AS s "
               "FROM seq q, range(7) c(c)), am AS (SELECT sent_id, p, first(c ORDER BY s DESC, c) AS pred FROM lg "
               "GROUP BY sent_id, p) ")


def _seq_lab_sql():
    return O.with_(*_TOK, O.SEQ, O.RAW_SPANS, O.ENT_RANK, O.seq_labels_cte(False)) + _ARGMAX_SQL


@query("argmax_labels", lambda: O.with_(*_TOK, O.SEQ) + _ARGMAX_SQL +
       "SELECT sent_id, string_agg(pred::VARCHAR, ',' ORDER BY p) AS pred FROM am GROUP BY sent_id")
def argmax_labels(spark, d):
    """Argmax over 7 class scores per token (first maximum wins)."""
    return _pred_gold(spark, d).select("sent_id", joined(F.col("pred")).alias("pred"))


@query("mask_ignored", lambda: _seq_lab_sql() +
       "SELECT l.sent_id, coalesce(string_agg(a.pred::VARCHAR, ',' ORDER BY l.p) FILTER (WHERE l.lab <> -100), '') AS pred, "
       "coalesce(string_agg(l.lab::VARCHAR, ',' ORDER BY l.p) FILTER (WHERE l.lab <> -100), '') AS gold "
       "FROM seq_lab l JOIN am a USING (sent_id, p) GROUP BY l.sent_id")
def mask_ignored(spark, d):
    """Drop -100 positions from prediction and reference alike."""
    m = _pred_gold(spark, d).withColumn("mk", pin(bio.mask_ignored(F.col("pred"), F.col("labels"))))
    return m.select("sent_id", joined(F.col("mk.pred")).alias("pred"), joined(F.col("mk.gold")).alias("gold"))


@query("token_accuracy", lambda: _seq_lab_sql() +
       "SELECT count(*)::BIGINT AS n_tokens, count_if(a.pred = l.lab)::BIGINT AS n_correct, "
       "round(coalesce(count_if(a.pred = l.lab) / nullif(count(*), 0), 0.0), 6) AS accuracy "
       "FROM seq_lab l JOIN am a USING (sent_id, p) WHERE l.lab <> -100")
def token_accuracy(spark, d):
    """Accuracy over unmasked tokens."""
    return metrics.token_accuracy(_pred_gold(spark, d), "pred", "labels")


def _span_prf_sql():
    ctes = [O.SENTENCES, O.PIECES, O.TOKENS, O.RAW_SPANS, O.ALIGNED,
            "al2 AS (SELECT sent_id, row_number() OVER (PARTITION BY sent_id ORDER BY c_start, c_stop, ner_class, ord) AS ord, "
            "first_tok, end_tok, start, stop, CASE ner_class WHEN 0 THEN 'Medikation' "
            "WHEN 1 THEN 'Dosis' ELSE 'Diagnose' END AS label FROM aligned WHERE first_tok IS NOT NULL)",
            O.filtered_cte("g4", "al2", "ord"), O.phrase_keys_cte(), O.grams_cte(), O.MATCHES, O.FILTERED,
            "gold_chunks AS (SELECT sent_id, label AS type, first_tok AS first, end_tok AS last FROM g4)",
            "pred_chunks AS (SELECT sent_id, label AS type, first_tok AS first, end_tok AS last FROM filtered)",
            O.PRF_FROM_CHUNKS]
    return O.with_(*ctes) + O.PRF_SELECT


def _span_chunks(col):
    return F.transform(col, lambda e: F.struct(e["label"].alias("type"), e["first_tok"].alias("first"),
                                               (e["end_tok"] - 1).alias("last")))


@query("span_prf", _span_prf_sql)
def span_prf(spark, d):
    """Span scorer — gold token spans (aligned, de-overlapped labelled
    spans) vs predicted token spans (gazetteer), P/R/F overall and per type.
    Both annotations are derived from the same tokenised rows, so the scorer
    is row-local plus one rollup; ``span_prf_tables`` scores two separately
    stored annotation tables."""
    from spanforge.functions.arrays import pin
    from spanforge.operators import spans as SP
    from spanforge.operators.matching import with_phrase_matches

    s = B.random_char_spans(_toks(spark, d))
    names = B.class_name_literal()
    al = F.transform(F.array_sort("spans"), lambda x: SP.align_expand(F.col("tokens"), x["start"], x["stop"])
                     .withField("label", F.get(names, x["ner_class"])))
    s = s.withColumn("gold", pin(SP.filter_spans(F.filter(al, lambda a: a.isNotNull()))))
    s = with_phrase_matches(s, B.phrases(spark, d))
    s = s.withColumn("pred", pin(SP.filter_spans(F.transform("matches", lambda x: x.dropFields("key")))))
    s = s.select(_span_chunks(F.col("gold")).alias("g"), _span_chunks(F.col("pred")).alias("p"))
    return metrics.ner_prf(s, "g", "p")


@query("span_prf_tables", _span_prf_sql)
def span_prf_tables(spark, d):
    """J7 on two annotated corpora: the gold corpus and the predicted one are written as
    tables of their own, bucketed and sorted by sentence, sentences without a span left
    out; the scorer joins them bucket by bucket without a shuffle."""
    from spanforge.operators import spans as SP
    from spanforge.operators.matching import with_phrase_matches

    s = B.random_char_spans(_toks(spark, d))
    names = B.class_name_literal()
    al = F.transform(F.array_sort("spans"), lambda x: SP.align_expand(F.col("tokens"), x["start"], x["stop"])
                     .withField("label", F.get(names, x["ner_class"])))
    gold = s.select("sent_id", pin(SP.filter_spans(F.filter(al, lambda a: a.isNotNull()))).alias("ents"))
    m = with_phrase_matches(_toks(spark, d), B.phrases(spark, d))
    pred = m.select("sent_id", pin(SP.filter_spans(F.transform("matches", lambda x: x.dropFields("key")))).alias("ents"))
    stored = []
    for name, corpus in (("gold", gold), ("pred", pred)):
        path = sinks.scratch_path(spark, f"spans-{name}")
        rows = corpus.where(F.size("ents") > 0).select("sent_id", _span_chunks(F.col("ents")).alias(name))
        stored.append(sinks.write_bucketed(rows, os.path.basename(path).replace("-", "_"), path, "sent_id"))
    return metrics.ner_prf_tables(*stored, "sent_id", "gold", "pred")


@query("user_metric", lambda: O.with_(*O.scoring_ctes()) +
       ", g AS (SELECT sent_id, string_agg(type || first || '-' || last, ';' ORDER BY first) AS c FROM gold_chunks GROUP BY sent_id), "
       "p AS (SELECT sent_id, string_agg(type || first || '-' || last, ';' ORDER BY first) AS c FROM pred_chunks GROUP BY sent_id) "
       "SELECT count(*)::BIGINT AS n, round(avg(CASE WHEN coalesce(g.c, '') = coalesce(p.c, '') THEN 1.0 ELSE 0.0 END), 6) "
       "AS exact_match FROM sentences LEFT JOIN g USING (sent_id) LEFT JOIN p USING (sent_id)")
def user_metric(spark, d):
    """U4: a caller's metric of gold and predicted chunks, here the share of sentences
    whose chunks all agree."""
    gp = scoring.gold_and_predicted(spark, d)
    return metrics.scored(gp, "gold_chunks", "pred_chunks", lambda g, p: (g == p).cast("double"), "exact_match")


# seeds / steps / metrics from the events table
def metric_rows(spark, d):
    e = table(spark, d, "events")
    seeds = F.array(*[F.lit(s) for s in SEEDS_A])
    names = F.array(F.lit("f1"), F.lit("precision"), F.lit("recall"))
    eid = F.col("event_id")
    return e.select(F.get(seeds, F.pmod((eid / 3).cast("long"), F.lit(3)).cast("int")).alias("seed"),
                    (eid / 9).cast("long").alias("step"), F.get(names, F.pmod(eid, F.lit(3)).cast("int")).alias("metric"),
                    F.col("event_type").alias("scope"), "value", eid.alias("event_id"))


MROWS = ("mrows AS (SELECT [42, 123, 2024][((event_id // 3) % 3) + 1] AS seed, event_id // 9 AS step, "
         "['f1', 'precision', 'recall'][(event_id % 3) + 1] AS metric, event_type AS scope, value, event_id FROM events)")
SEEDM = ("seedm AS (SELECT seed, scope, metric, arg_max(value, event_id) AS value FROM mrows "
         "GROUP BY seed, scope, metric)")


def seed_metric_table(spark, d):
    """One row per (seed, scope, metric): the value at the latest step."""
    m = metric_rows(spark, d)
    return m.groupBy("seed", "scope", "metric").agg(F.max_by("value", "event_id").alias("value"))


@query("seed_metrics", lambda: O.with_(MROWS, SEEDM) + "SELECT seed, scope, metric, value FROM seedm")
def seed_metrics(spark, d):
    """Collect one metric row per seed (tidy: seed, scope, metric, value)."""
    return seed_metric_table(spark, d)


@query("seed_mean_std", lambda: O.with_(MROWS) +
       ", per AS (SELECT seed, metric, avg(value) AS v FROM mrows GROUP BY seed, metric) "
       "SELECT metric, count(*)::BIGINT AS n_seeds, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std "
       "FROM per GROUP BY metric")
def seed_mean_std(spark, d):
    """Mean and population std over seeds of each overall metric."""
    per = metric_rows(spark, d).groupBy("seed", "metric").agg(F.avg("value").alias("value"))
    return metrics.seed_mean_std(per, ["metric"])


@query("seed_mean_std_by_class", lambda: O.with_(MROWS, SEEDM) +
       "SELECT scope, metric, count(*)::BIGINT AS n_seeds, round(avg(value), 6) AS mean, "
       "round(stddev_pop(value), 6) AS std FROM seedm GROUP BY scope, metric")
def seed_mean_std_by_class(spark, d):
    """mean/std over seeds per category x metric (seeds lacking a
    category are simply absent from its average)."""
    return metrics.seed_mean_std(seed_metric_table(spark, d), ["scope", "metric"])


@query("best_checkpoint", lambda: O.with_(MROWS) +
       "SELECT seed, first(step ORDER BY value DESC, step) AS best_step, max(value) AS best_f1 "
       "FROM mrows WHERE metric = 'f1' GROUP BY seed")
def best_checkpoint(spark, d):
    """Per run the checkpoint (step) with the best f1; ties -> earliest."""
    f1 = metric_rows(spark, d).where(F.col("metric") == "f1")
    b = metrics.best_checkpoint(f1, ["seed"], "step", "value")
    return b.select("seed", F.col("step").alias("best_step"), F.col("value").alias("best_f1"))


@query("weighted_score", lambda: O.with_(MROWS) +
       ", pv AS (SELECT seed, step, max(CASE WHEN metric = 'f1' THEN value END) AS f, "
       "max(CASE WHEN metric = 'precision' THEN value END) AS p, max(CASE WHEN metric = 'recall' THEN value END) AS r "
       "FROM mrows GROUP BY seed, step) "
       "SELECT seed, step, round(1.0 * coalesce(f, 0) + 0.0 * coalesce(p, 0) + 0.0 * coalesce(r, 0), 6) AS score FROM pv")
def weighted_score(spark, d):
    """Selection score = ents_f*1 + p*0 + r*0 per checkpoint."""
    m = metric_rows(spark, d)
    pv = m.groupBy("seed", "step").agg(
        F.max(F.when(F.col("metric") == "f1", F.col("value"))).alias("ents_f"),
        F.max(F.when(F.col("metric") == "precision", F.col("value"))).alias("ents_p"),
        F.max(F.when(F.col("metric") == "recall", F.col("value"))).alias("ents_r"))
    return pv.select("seed", "step", metrics.weighted_score({"ents_f": 1.0, "ents_p": 0.0, "ents_r": 0.0})
                     .alias("score"))


@query("format_report", lambda: O.with_(MROWS, SEEDM) +
       ", ms AS (SELECT scope, metric, avg(value) AS mean, stddev_pop(value) AS std FROM seedm GROUP BY scope, metric) "
       "SELECT scope, metric, rpad(scope, 12, ' ') || printf('%.4f ± %.4f', mean, std) AS line FROM ms")
def format_report(spark, d):
    """Fixed-decimal, padded report lines."""
    ms = metrics.seed_mean_std(seed_metric_table(spark, d), ["scope", "metric"])
    return ms.select("scope", "metric", metrics.format_report(F.col("scope"), F.col("mean"), F.col("std")).alias("line"))


# --- U: user functions ------------------------------------------------------------------

@query("udf_row_map", lambda: O.with_(O.SENTENCES) + "SELECT sent_id, length(sentence)::BIGINT AS n_chars FROM sentences")
def udf_row_map(spark, d):
    """An opaque per-row Python function (via mapInPandas)."""
    s = B.sentences(spark, d)
    return pipeline.row_map(s, lambda r: {"sent_id": r["sent_id"], "n_chars": len(r["sentence"])},
                            "sent_id long, n_chars long", ["sent_id", "sentence"])


@query("udf_batch_map", lambda: O.with_(O.SENTENCES) +
       "SELECT sent_id, (length(sentence) - length(replace(sentence, ',', '')))::BIGINT AS n_commas FROM sentences")
def udf_batch_map(spark, d):
    """A batched pandas function over Arrow batches."""
    s = B.sentences(spark, d).select("sent_id", "sentence")

    def fn(pdf):
        return pdf.assign(n_commas=pdf["sentence"].str.count(",").astype("int64"))[["sent_id", "n_commas"]]
    return pipeline.batch_map(s, fn, "sent_id long, n_commas long")


def _components():
    p = pipeline.Pipeline()
    p.add("tokenize", tokens.tokenize)
    p.add("length", lambda df: df.withColumn("n_tokens", F.size("tokens")), after="tokenize")
    p.add("keys", lambda df: df.select("sent_id", "sentence"), first=True)
    return p


@query("pipeline_order", lambda: O.with_(*_TOK) +
       "SELECT s.sent_id, count(t.i)::INTEGER AS n_tokens, 'keys,tokenize,length' AS components "
       "FROM sentences s LEFT JOIN tokens t USING (sent_id) GROUP BY s.sent_id")
def pipeline_order(spark, d):
    """Named components with placement, run over the corpus; the output lists each
    sentence with the component order applied."""
    p = _components()
    order = ",".join(p.names)
    return p(B.sentences(spark, d)).select("sent_id", "n_tokens", F.lit(order).alias("components"))


@query("pipeline_stream", lambda: O.with_(*_TOK) +
       "SELECT s.sent_id, count(t.i)::INTEGER AS n_tokens, 'keys,tokenize,length' AS components "
       "FROM sentences s LEFT JOIN tokens t USING (sent_id) GROUP BY s.sent_id")
def pipeline_stream(spark, d):
    """The named components of ``pipeline_order`` over a stream of texts: sentences
    land as JSONL files, a checkpointed file-source stream puts each through the chain
    and appends it to a Parquet table, which is read back."""
    from spanforge.streaming.corpus_stream import start_component_stream
    src, out = sinks.scratch_path(spark, "texts"), sinks.scratch_path(spark, "components")
    sinks.write_jsonl(B.sentences(spark, d).select("sent_id", "sentence"), src)
    p = _components()
    q = start_component_stream(spark, p, src, "sent_id long, sentence string", out, name=os.path.basename(out),
                               columns=["sent_id", "n_tokens"])
    q.awaitTermination()
    rows = spark.read.schema("sent_id long, n_tokens int").parquet(out)
    return rows.select("sent_id", "n_tokens", F.lit(",".join(p.names)).alias("components"))
