"""End-to-end: tokenise -> gazetteer match -> de-overlap -> BIO -> chunks -> P/R/F.

Physical shape: scan -> split lines -> tokenise -> match -> de-overlap -> BIO
-> chunks, all row-local Project steps over each sentence's arrays (the
gazetteer is a size-checked hash set inside the expression); the only
exchange is the final rollup, which moves three class counters per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.functions.arrays import pin
from spanforge.functions.labels import class_id
from spanforge.operators import bio, metrics, spans, tokens
from spanforge.operators import matching
from spanforge.operators.matching import with_phrase_matches
from spanforge.plans import bindings as B



def tokenized_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenize(B.sentences(spark, sf_dir))


def gazetteer_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences + ``ents``: gazetteer matches, de-overlapped (H6 -> G3), all
    inside each sentence row (no shuffle for a lexicon that fits a hash set)."""
    s = tokenized_sentences(spark, sf_dir)
    m = with_phrase_matches(s, B.phrases(spark, sf_dir))
    ents = F.transform("matches", lambda x: x.dropFields("key"))
    return matching.overwrite_entities(m, pin(spans.filter_spans(ents))).drop("matches")


def gold_and_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per sentence: gold BIO ids (G6 over word tokens), predicted ids (hash
    flips), and both chunk lists (J3)."""
    g = gazetteer_entities(spark, sf_dir)
    ents = F.transform("ents", lambda e: F.struct(e["start"].alias("start"), e["stop"].alias("stop"),
                                                  class_id(e["label"]).alias("class_id")))
    g = g.withColumn("__ents", pin(ents))          # once per row (see functions.arrays.pin)
    g = g.withColumn("gold_tags", pin(bio.token_labels(F.col("tokens"), F.col("__ents")))).drop("__ents")
    g = g.withColumn("pred_tags", pin(B.flip_tags(F.col("gold_tags"), F.col("sent_id"))))
    return g.withColumns({"gold_chunks": pin(bio.bio_chunks(F.col("gold_tags"))),
                          "pred_chunks": pin(bio.bio_chunks(F.col("pred_tags")))})


def ner_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: overall and per-class entity precision / recall / F1."""
    gp = gold_and_predicted(spark, sf_dir)
    return metrics.ner_prf(gp, "gold_chunks", "pred_chunks")
