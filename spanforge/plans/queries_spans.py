"""Registered queries: span finding and tags (F), tokens, alignment, BIO (G)."""

from __future__ import annotations

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from spanforge.functions.arrays import pin
from spanforge.functions.labels import bio_tag, class_id
from spanforge.operators import bio, spans, tokens
from spanforge.plans import bindings as B
from spanforge.plans import oracle as O
from spanforge.plans import scoring
from spanforge.plans.queries_corpus import joined
from spanforge.plans.registry import query
from spanforge.schemas import CLASS_NAMES
from spanforge.session import table


def _req():
    return [O.SENTENCES, O.RAW_SPANS, O.REQUESTS]


def _requests(spark, d):
    return B.entity_requests(spark, d).withColumn("low", pin(F.lower("sentence")))


# --- F: span finding, tags, QA ---------------------------------------------------

@query("find_spans_first", lambda: O.with_(*_req(), O.F1) + "SELECT sent_id, pos, text, label, start, stop FROM f1")
def find_spans_first(spark, d):
    """first case-insensitive occurrence; repeats share one span; miss -1."""
    r = _requests(spark, d).withColumn("sp", spans.find_spans_first(F.col("sentence"), F.col("entities"), F.col("low")))
    return r.select("sent_id", F.inline_outer(F.arrays_zip(F.col("entities").alias("e"), F.col("sp").alias("s")))) \
        .where(F.col("e").isNotNull()) \
        .select("sent_id", F.col("s.ord").alias("pos"), "e.text", "e.label", "s.start", "s.stop")


def _next_spans(spark, d):
    return _requests(spark, d).withColumn("sp", spans.find_spans_next(F.col("sentence"), F.col("entities"), F.col("low")))


@query("find_spans_next", lambda: O.with_(*_req(), O.F2) + "SELECT sent_id, pos, text, label, start, stop FROM f2s")
def find_spans_next(spark, d):
    """a repeated term continues after its previous hit; a miss does not advance."""
    r = _next_spans(spark, d)
    return r.select("sent_id", F.inline_outer(F.arrays_zip(F.col("entities").alias("e"), F.col("sp").alias("s")))) \
        .where(F.col("e").isNotNull()) \
        .select("sent_id", F.col("s.ord").alias("pos"), "e.text", "e.label", "s.start", "s.stop")


_CLS = "CASE label WHEN 'Medikation' THEN 0 WHEN 'Dosis' THEN 1 WHEN 'Diagnose' THEN 2 END"


@query("spans_to_arrays", lambda: O.with_(*_req(), O.F2) +
       f"SELECT sent_id, {O.joined(_CLS, 'start, pos')} AS ner_class, {O.joined('start', 'start, pos')} AS start, "
       f"{O.joined('stop', 'start, pos')} AS stop FROM f2s GROUP BY sent_id")
def spans_to_arrays(spark, d):
    """spans sorted by start (stable) as parallel class/start/stop lists."""
    r = _next_spans(spark, d).withColumn("nl", spans.spans_to_labels(F.col("sp")))
    return r.select("sent_id", joined(F.col("nl.ner_class")).alias("ner_class"),
                    joined(F.col("nl.start")).alias("start"), joined(F.col("nl.stop")).alias("stop"))


@query("reject_unmatched", lambda: O.with_(*_req(), O.F2) +
       "SELECT sent_id, bool_or(start = -1) AS rejected FROM f2s GROUP BY sent_id")
def reject_unmatched(spark, d):
    """A row is rejected when any requested term is not found."""
    r = _next_spans(spark, d)
    return r.select("sent_id", spans.has_unmatched(F.col("sp")).alias("rejected"))


@query("parse_tags_entities", lambda: O.with_(O.tagged_cte()) +
       f"SELECT line_key, unnest(regexp_extract_all(inner_text, {O.TAG_SQL}, 2)) AS text, "
       f"unnest(regexp_extract_all(inner_text, {O.TAG_SQL}, 1)) AS label, "
       f"(generate_subscripts(regexp_extract_all(inner_text, {O.TAG_SQL}, 1), 1) - 1)::INTEGER AS pos FROM tagged")
def parse_tags_entities(spark, d):
    """inline tags -> ordered (text, label) entities."""
    t = B.tagged_lines(spark, d).withColumn("ents", spans.parse_tags(F.col("value")))
    return t.select("line_key", F.posexplode_outer("ents").alias("pos", "e")).where(F.col("e").isNotNull()) \
        .select("line_key", "e.text", "e.label", F.col("pos").cast("int").alias("pos"))


@query("strip_tags", lambda: O.with_(O.tagged_cte()) +
       f"SELECT line_key, regexp_replace(inner_text, {O.TAG_SQL}, '\\2', 'g') AS text FROM tagged")
def strip_tags(spark, d):
    """tagged sentence -> plain text."""
    return B.tagged_lines(spark, d).select("line_key", spans.strip_tags(F.col("value")).alias("text"))


@query("span_text", lambda: O.with_(*_req(), O.F2) +
       "SELECT sent_id, pos, label, start, stop, substr(sentence, start + 1, stop - start) AS span_text "
       "FROM f2s WHERE start >= 0")
def span_text(spark, d):
    """slice every found span out of its sentence."""
    r = _next_spans(spark, d)
    e = r.select("sent_id", "sentence", F.inline_outer("sp")).where(F.col("start") >= 0)
    return e.select("sent_id", F.col("ord").alias("pos"), "label", "start", "stop",
                    spans.span_text(F.col("sentence"), F.col("start"), F.col("stop")).alias("span_text"))


@query("span_qa", lambda: O.with_(*_req(), O.F2) + """, found AS (SELECT * FROM f2s WHERE start >= 0),
ov AS (SELECT a.sent_id, a.pos, bool_or(b.pos IS NOT NULL) AS overlaps FROM found a LEFT JOIN found b
       ON a.sent_id = b.sent_id AND a.pos <> b.pos AND a.start < b.stop AND b.start < a.stop GROUP BY a.sent_id, a.pos)
SELECT f.label, count(*)::BIGINT AS n_requested, count_if(f.start >= 0)::BIGINT AS n_found,
       count_if(f.start >= 0 AND lower(substr(f.sentence, f.start + 1, f.stop - f.start)) <> lower(f.text))::BIGINT AS n_mismatch,
       count_if(coalesce(ov.overlaps, false))::BIGINT AS n_overlap,
       count_if(f.label NOT IN ('Medikation', 'Dosis', 'Diagnose'))::BIGINT AS n_bad_label
FROM f2s f LEFT JOIN ov ON f.sent_id = ov.sent_id AND f.pos = ov.pos GROUP BY f.label""")
def span_qa(spark, d):
    """per class — requested, found, slice/term mismatches, overlapping spans,
    labels outside the class list."""
    r = _next_spans(spark, d)
    z = F.arrays_zip(F.col("entities").alias("e"), F.col("sp").alias("s"))
    r = r.withColumn("z", z)
    # overlap with another found span of the same sentence (row-local)
    z2 = F.transform("z", lambda x: F.struct(
        x["e"]["label"].alias("label"), x["e"]["text"].alias("text"), x["s"]["start"].alias("start"),
        x["s"]["stop"].alias("stop"),
        ((x["s"]["start"] >= 0) & F.exists("z", lambda y: (y["s"]["ord"] != x["s"]["ord"]) & (y["s"]["start"] >= 0)
                                           & (x["s"]["start"] < y["s"]["stop"]) & (y["s"]["start"] < x["s"]["stop"])))
        .alias("overlaps")))
    e = r.select("sentence", F.inline_outer(z2)).where(F.col("label").isNotNull())
    found = F.col("start") >= 0
    mism = found & (F.lower(spans.span_text(F.col("sentence"), F.col("start"), F.col("stop"))) != F.lower("text"))
    return e.groupBy("label").agg(F.count("*").alias("n_requested"), F.count_if(found).alias("n_found"),
                                  F.count_if(mism).alias("n_mismatch"), F.count_if("overlaps").alias("n_overlap"),
                                  F.count_if(~F.col("label").isin(*CLASS_NAMES)).alias("n_bad_label"))


@query("list_entities", lambda: O.with_(*O.scoring_ctes()[:7]) +
       "SELECT f.sent_id, substr(s.sentence, f.start + 1, f.stop - f.start) AS text, f.label "
       "FROM filtered f JOIN sentences s USING (sent_id)")
def list_entities(spark, d):
    """F8: (text, label) of every entity of every sentence."""
    g = scoring.gazetteer_entities(spark, d)
    e = g.select("sent_id", "sentence", F.inline_outer("ents")).where(F.col("label").isNotNull())
    return e.select("sent_id", spans.span_text(F.col("sentence"), F.col("start"), F.col("stop")).alias("text"), "label")


# --- G: tokens, alignment, BIO -----------------------------------------------------

def _tok_spans(spark, d):
    s = B.random_char_spans(scoring.tokenized_sentences(spark, d))
    return s


@query("align_expand", lambda: O.with_(O.SENTENCES, O.PIECES, O.TOKENS, O.RAW_SPANS, O.ALIGNED) +
       "SELECT sent_id, ord, c_start, c_stop, first_tok, end_tok, start, stop FROM aligned")
def align_expand(spark, d):
    """Character span -> token span expanded to partly covered tokens; NULL
    when no token overlaps (e.g. a span of blanks)."""
    s = _tok_spans(spark, d)
    al = F.transform("spans", lambda x: F.struct(
        x["ord"].alias("ord"), x["start"].alias("c_start"), x["stop"].alias("c_stop"),
        spans.align_expand(F.col("tokens"), x["start"], x["stop"]).alias("a")))
    return s.select("sent_id", F.inline_outer(al)).where(F.col("ord").isNotNull()).select(
        "sent_id", "ord", "c_start", "c_stop", "a.first_tok", "a.end_tok", "a.start", "a.stop")


def token_corpus(spark, d):
    """Labelled sentences (+ synthetic rows appended to train) -> tokens ->
    expanded token spans -> overlaps removed; one row per sentence."""
    s = _tok_spans(spark, d).withColumn("split", B.split_of(F.col("doc_id")))
    names = B.class_name_literal()
    # labelled rows hold their spans sorted by start (F3); ties keep that order
    al = F.transform(F.array_sort("spans"), lambda x: spans.align_expand(F.col("tokens"), x["start"], x["stop"])
                     .withField("label", F.get(names, x["ner_class"])))
    al = F.filter(al, lambda a: a.isNotNull())
    corpus = s.select("sent_id", "sentence", "tokens", "split", pin(spans.filter_spans(al)).alias("ents"))
    synth = tokens.tokenize(table(spark, d, "benchmark").select(
        (-1 - F.col("item_id")).alias("sent_id"), F.col("text").alias("sentence")))
    synth = synth.select("sent_id", "sentence", "tokens", F.lit("train").alias("split"),
                         F.array().cast(corpus.schema["ents"].dataType.simpleString()).alias("ents"))
    return corpus.unionByName(synth)


_G4_SQL = lambda: O.with_(O.SENTENCES, O.PIECES, O.TOKENS, O.RAW_SPANS, O.ALIGNED,
                          "al2 AS (SELECT sent_id, row_number() OVER (PARTITION BY sent_id ORDER BY c_start, c_stop, ner_class, ord) "
                          "AS ord, first_tok, end_tok, start, stop, CASE ner_class WHEN 0 THEN "
                          "'Medikation' WHEN 1 THEN 'Dosis' ELSE 'Diagnose' END AS label FROM aligned "
                          "WHERE first_tok IS NOT NULL)", O.filtered_cte("g4", "al2", "ord"))


@query("build_token_corpus", lambda: _G4_SQL() +
       f"SELECT g.sent_id, {O.SPLIT_OF.replace('doc_id', '(g.sent_id // 2147483648)')} AS split, "
       "g.first_tok, (g.end_tok - 1)::INTEGER AS last_tok, g.start, g.stop, g.label FROM g4 g")
def build_token_corpus(spark, d):
    """Token-aligned, non-overlapping entity corpus rows."""
    c = token_corpus(spark, d)
    e = c.select("sent_id", "split", F.inline_outer("ents")).where(F.col("label").isNotNull())
    return e.select("sent_id", "split", "first_tok", (F.col("end_tok") - 1).alias("last_tok"), "start", "stop",
                    "label")


@query("sink_token_corpus", lambda: _G4_SQL() +
       ", e AS (SELECT sent_id, string_agg(first_tok || '-' || (end_tok - 1) || ':' || label, ';' ORDER BY first_tok) AS ents "
       "FROM g4 GROUP BY sent_id), "
       "t AS (SELECT sent_id, count(*)::INTEGER AS n, string_agg(token, ' ' ORDER BY i) AS toks FROM tokens GROUP BY sent_id), "
       f"bt AS (SELECT item_id, list_filter(regexp_extract_all(text, {O.q(O.TOKEN_PATTERN)}), "
       f"lambda x: substr(x, 1, 1) NOT IN {O.BLANKS}) AS l FROM benchmark) "
       f"SELECT s.sent_id, {O.SPLIT_OF.replace('doc_id', 's.doc_id')} AS split, coalesce(t.n, 0) AS n_tokens, "
       "coalesce(t.toks, '') AS tokens, coalesce(e.ents, '') AS ents FROM sentences s LEFT JOIN t USING (sent_id) "
       "LEFT JOIN e USING (sent_id) "
       "UNION ALL SELECT -1 - item_id, 'train', len(l)::INTEGER, array_to_string(l, ' '), '' FROM bt")
def sink_token_corpus(spark, d):
    """Token corpus written per split (parquet, partitioned) and read back: tokens
    and entities of every sentence, synthetic rows included."""
    from spanforge.sources import sinks
    path = sinks.scratch_path(spark, "tokcorpus")
    sinks.write_corpus(token_corpus(spark, d), path)
    ents = F.array_join(F.transform("ents", lambda e: F.concat_ws(
        "", e["first_tok"].cast("string"), F.lit("-"), (e["end_tok"] - 1).cast("string"), F.lit(":"), e["label"])), ";")
    return spark.read.parquet(path).select(
        "sent_id", "split", F.size("tokens").alias("n_tokens"),
        F.array_join(tokens.token_texts(F.col("tokens")), " ").alias("tokens"), ents.alias("ents"))


def _model_inputs(spark, d, last_match=False):
    s = _tok_spans(spark, d)
    seq = tokens.truncate_with_specials(F.col("tokens"))
    srt = F.array_sort("spans")
    s = s.withColumn("__ents", pin(F.transform(srt, lambda x: F.struct(
        x["start"].alias("start"), x["stop"].alias("stop"), x["ner_class"].alias("class_id")))))
    ents = F.col("__ents")
    s = s.withColumn("seq", pin(seq))
    return s.select("doc_id", "line_no", "sent_id", "seq", pin(bio.token_labels(F.col("seq"), ents, last_match)).alias("labels"))


@query("truncate_with_specials", lambda: O.with_(O.SENTENCES, O.PIECES, O.TOKENS, O.SEQ_128) +
       "SELECT sent_id, count(*)::INTEGER AS n_out, string_agg(token, ' ' ORDER BY p) AS tokens FROM seq GROUP BY sent_id")
def truncate_with_specials(spark, d):
    """[CLS] + first 126 tokens + [SEP] (sequence cap 128)."""
    s = scoring.tokenized_sentences(spark, d)
    seq = tokens.truncate_with_specials(F.col("tokens"), 128)
    return s.select("sent_id", F.size(seq).alias("n_out"),
                    F.array_join(F.transform(seq, lambda t: t["text"]), " ").alias("tokens"))


def _bio_sql(last):
    return (O.with_(O.SENTENCES, O.PIECES, O.TOKENS, O.SEQ, O.RAW_SPANS, O.ENT_RANK, O.seq_labels_cte(last))
            + "SELECT sent_id, string_agg(lab::VARCHAR, ',' ORDER BY p) AS labels FROM seq_lab GROUP BY sent_id")


@query("bio_first_match", lambda: _bio_sql(False))
def bio_first_match(spark, d):
    """G6 (+G8): sub-word labels, first containing entity wins, specials -100."""
    m = _model_inputs(spark, d, False)
    return m.select("sent_id", joined(F.col("labels")).alias("labels"))


@query("bio_last_match", lambda: _bio_sql(True))
def bio_last_match(spark, d):
    """As G6, but the last containing entity wins (batched variant)."""
    m = _model_inputs(spark, d, True)
    return m.select("sent_id", joined(F.col("labels")).alias("labels"))


@query("decode_labels", lambda: O.with_(O.SENTENCES, O.PIECES, O.TOKENS, O.SEQ, O.RAW_SPANS, O.ENT_RANK,
                                        O.seq_labels_cte(False)) +
       "SELECT sent_id, p::INTEGER AS pos, token, CASE WHEN lab = -100 THEN '-100' ELSE "
       "['O','B-Medikation','I-Medikation','B-Dosis','I-Dosis','B-Diagnose','I-Diagnose'][lab + 1] END AS tag "
       "FROM seq_lab")
def decode_labels(spark, d):
    """Token -> tag name (or -100) view."""
    m = _model_inputs(spark, d, False)
    z = F.arrays_zip(F.col("seq").alias("t"), F.col("labels").alias("l"))
    e = m.select("sent_id", F.posexplode_outer(z).alias("pos", "x")).where(F.col("x").isNotNull())
    tag = F.when(F.col("x.l") == -100, F.lit("-100")).otherwise(bio_tag(F.col("x.l")))
    return e.select("sent_id", F.col("pos").cast("int").alias("pos"), F.col("x.t.text").alias("token"), tag.alias("tag"))


@query("pad_batch", lambda: O.with_(O.SENTENCES, O.PIECES, O.TOKENS, O.SEQ, O.RAW_SPANS, O.ENT_RANK,
                                    O.seq_labels_cte(False)) +
       ", n AS (SELECT sent_id, count(*) AS n, string_agg(lab::VARCHAR, ',' ORDER BY p) AS labs FROM seq_lab GROUP BY sent_id), "
       "b AS (SELECT n.*, max(n) OVER (PARTITION BY s.doc_id, s.line_no // 16) AS batch_len FROM n JOIN sentences s USING (sent_id)) "
       "SELECT sent_id, batch_len::INTEGER AS batch_len, (batch_len - n)::INTEGER AS n_pad, "
       "labs || repeat(',-100', (batch_len - n)::INTEGER) AS labels FROM b")
def pad_batch(spark, d):
    """Pad label sequences to the longest in their batch with -100.
    A batch is 16 consecutive lines of a document (bounded groups)."""
    b = _model_inputs(spark, d).withColumn("batch", (F.col("line_no") / 16).cast("int"))
    w = Window.partitionBy("doc_id", "batch")
    b = b.withColumn("batch_len", F.max(F.size("labels")).over(w))
    padded = bio.pad_to(F.col("labels"), F.col("batch_len"), -100)
    return b.select("sent_id", F.col("batch_len").cast("int"), (F.col("batch_len") - F.size("labels")).alias("n_pad"),
                    joined(padded).alias("labels"))


@query("strided_windows", lambda: O.with_(O.SENTENCES, O.PIECES, O.TOKENS) +
       ", n AS (SELECT sent_id, count(*) AS n FROM tokens GROUP BY sent_id) "
       "SELECT sent_id, r.s::INTEGER AS first_tok, least(r.s + 128, n)::INTEGER AS end_tok "
       "FROM n, range(0, n, 96) r(s) WHERE r.s = 0 OR r.s - 96 + 128 < n")
def strided_windows(spark, d):
    """128-token windows every 96 tokens (the redundant tail window dropped)."""
    s = scoring.tokenized_sentences(spark, d)
    w = tokens.strided_windows(F.col("tokens"), 128, 96)
    return s.select("sent_id", F.inline_outer(w)).where(F.col("first_tok").isNotNull()).select(
        "sent_id", "first_tok", "end_tok")


@query("detokenize", lambda: O.with_(O.SENTENCES, O.PIECES, O.TOKENS) +
       "SELECT sent_id, string_agg(token || CASE WHEN ws THEN ' ' ELSE '' END, '' ORDER BY i) AS text "
       "FROM tokens GROUP BY sent_id")
def detokenize(spark, d):
    """Rebuild text from words and trailing-space flags."""
    s = scoring.tokenized_sentences(spark, d).where(F.size("tokens") > 0)
    words = F.transform("tokens", lambda t: t["text"])
    spaces = F.transform("tokens", lambda t: t["ws"])
    return s.select("sent_id", tokens.detokenize(words, spaces).alias("text"))


@query("token_slice", lambda: O.with_(O.SENTENCES, O.PIECES, O.TOKENS) +
       ", a AS (SELECT sent_id, max(CASE WHEN i = 2 THEN start END) AS s, max(CASE WHEN i = 3 THEN stop END) AS e "
       "FROM tokens GROUP BY sent_id HAVING count(*) >= 4) "
       "SELECT sent_id, substr(sentence, s + 1, e - s) AS text FROM a JOIN sentences USING (sent_id)")
def token_slice(spark, d):
    """Text of tokens [2, 4) with inner whitespace kept."""
    s = scoring.tokenized_sentences(spark, d).where(F.size("tokens") >= 4)
    return s.select("sent_id", tokens.token_slice_text(F.col("sentence"), F.col("tokens"), F.lit(2), F.lit(4))
                    .alias("text"))


@query("span_from_tokens", lambda: O.with_(O.SENTENCES, O.PIECES, O.TOKENS) +
       ", a AS (SELECT sent_id, max(CASE WHEN i = 2 THEN start END) AS start, max(CASE WHEN i = 3 THEN stop END) AS stop "
       "FROM tokens GROUP BY sent_id HAVING count(*) >= 4) "
       f"SELECT sent_id, start::INTEGER AS start, stop::INTEGER AS stop, "
       f"['Medikation','Dosis','Diagnose'][{O.draw('3', '42', 'sent_id', chr(39) + 'g14' + chr(39))} + 1] AS label, "
       "substr(sentence, start + 1, stop - start) AS text FROM a JOIN sentences USING (sent_id)")
def span_from_tokens(spark, d):
    """Labelled span from a token index range (tokens 2..4)."""
    s = scoring.tokenized_sentences(spark, d).where(F.size("tokens") >= 4)
    lab = F.get(B.class_name_literal(), B.draw_index(3, 42, F.col("sent_id"), "g14"))
    st = F.get(F.col("tokens"), 2)["start"]
    sp = F.get(F.col("tokens"), 3)["stop"]
    return s.select("sent_id", st.alias("start"), sp.alias("stop"), lab.alias("label"),
                    spans.span_text(F.col("sentence"), st, sp).alias("text"))


@query("doc_length", lambda: O.with_(O.SENTENCES, O.PIECES, O.TOKENS) +
       "SELECT s.doc_id, count(t.i)::BIGINT AS n_tokens FROM sentences s LEFT JOIN tokens t USING (sent_id) "
       "GROUP BY s.doc_id")
def doc_length(spark, d):
    """Document length in tokens (sum over its lines)."""
    s = scoring.tokenized_sentences(spark, d)
    return s.groupBy("doc_id").agg(F.sum(F.size("tokens")).cast("long").alias("n_tokens"))


__all__ = ["class_id"]


@query("stream_token_corpus", lambda: _G4_SQL() +
       f"SELECT g.sent_id, {O.SPLIT_OF.replace('doc_id', '(g.sent_id // 2147483648)')} AS split, "
       "g.first_tok, (g.end_tok - 1)::INTEGER AS last_tok, g.label FROM g4 g")
def stream_token_corpus(spark, d):
    """G4 under Structured Streaming: the labelled corpus lands as JSONL files,
    a file-source stream (availableNow trigger, checkpointed) tokenises, aligns
    and de-overlaps it into a split-partitioned Parquet token corpus, which is
    read back."""
    from spanforge.sources import sinks
    from spanforge.streaming.corpus_stream import start_token_corpus_stream
    src = sinks.scratch_path(spark, "stream-in")
    out = sinks.scratch_path(spark, "stream-out")
    sinks.write_jsonl(B.labelled_sentences(spark, d).select("sent_id", "sentence", "ner_labels", "split"), src)
    q = start_token_corpus_stream(spark, src, out, name=os.path.basename(out))
    q.awaitTermination()
    c = spark.read.parquet(out)
    e = c.select("sent_id", "split", F.inline_outer("ents")).where(F.col("label").isNotNull())
    return e.select("sent_id", "split", "first_tok", (F.col("end_tok") - 1).alias("last_tok"), "label")
