"""Registered queries (one per SURVEY §2 operator) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.operators import metrics, spans, tokens
from spanforge.operators.matching import phrase_match
from spanforge.plans import bindings as B
from spanforge.plans import oracle as O
from spanforge.plans import scoring
from spanforge.plans.registry import query

# ---------------------------------------------------------------------------
# Phase 1: tokenise -> phrase match -> de-overlap -> BIO -> chunks -> P/R/F
# ---------------------------------------------------------------------------


@query("tokenize_offsets", lambda: O.with_(O.SENTENCES, O.PIECES, O.TOKENS)
       + "SELECT sent_id, i, token, start, stop, ws FROM tokens")
def tokenize_offsets(spark, d):
    """G1: one row per token with code-point offsets and trailing-space flag."""
    s = scoring.tokenized_sentences(spark, d)
    return tokens.explode_tokens(s, ["sent_id"]).select("sent_id", "i", "token", "start", "stop", "ws")


@query("phrase_match", lambda: O.with_(O.SENTENCES, O.PIECES, O.TOKENS, O.phrase_keys_cte(), O.grams_cte(),
                                       O.MATCHES)
       + "SELECT sent_id, first_tok, end_tok, start, stop, label FROM matches")
def q_phrase_match(spark, d):
    """H6: gazetteer matches (exact token sequences) in every sentence."""
    s = scoring.tokenized_sentences(spark, d)
    m = phrase_match(s, B.phrases(spark, d), ["sent_id"])
    return m.select("sent_id", "first_tok", "end_tok", "start", "stop", "label")


@query("filter_spans", lambda: O.with_(O.SENTENCES, O.PIECES, O.TOKENS, O.phrase_keys_cte(), O.grams_cte(),
                                       O.MATCHES, O.FILTERED)
       + "SELECT sent_id, first_tok, end_tok, start, stop, label FROM filtered")
def q_filter_spans(spark, d):
    """Greedy longest-first de-overlap of the gazetteer matches."""
    g = scoring.gazetteer_entities(spark, d)
    return spans.explode_spans(g, ["sent_id"], "ents").select(
        "sent_id", "first_tok", "end_tok", "start", "stop", "label")


@query("bio_chunks", lambda: O.with_(*O.scoring_ctes())
       + "SELECT sent_id, 'gold' AS side, type, first::INTEGER AS first, last::INTEGER AS last FROM gold_chunks "
       "UNION ALL SELECT sent_id, 'pred', type, first::INTEGER, last::INTEGER FROM pred_chunks")
def q_bio_chunks(spark, d):
    """BIO sequences -> typed chunks, for gold and hash-perturbed tags."""
    gp = scoring.gold_and_predicted(spark, d)
    both = F.concat(F.transform("gold_chunks", lambda c: c.withField("side", F.lit("gold"))),
                    F.transform("pred_chunks", lambda c: c.withField("side", F.lit("pred"))))
    return gp.select("sent_id", F.inline_outer(both)).where("type IS NOT NULL").select(
        "sent_id", "side", "type", "first", "last")


@query("ner_micro_prf", lambda: O.with_(*O.scoring_ctes(), O.PRF_FROM_CHUNKS)
       + O.PRF_SELECT + " WHERE scope = 'overall'")
def q_ner_micro(spark, d):
    """Micro precision / recall / F1 over exact (sentence, type, first, last)."""
    return scoring.ner_scores(spark, d).where(F.col("scope") == "overall")


@query("ner_prf_by_class", lambda: O.with_(*O.scoring_ctes(), O.PRF_FROM_CHUNKS) + O.PRF_SELECT)
def q_ner_by_class(spark, d):
    """J5 (+J4): per-class and overall entity scores in one rollup."""
    return scoring.ner_scores(spark, d)


__all__ = ["metrics"]
