"""Operator inputs derived by Spark from the given tables.

The reference's corpora and code lists are not available offline, so every
input an operator needs is derived from the driver tables; each derivation is
a plain DataFrame transformation whose work grows with the tables.  The SQL
oracle in ``spanforge.plans.oracle`` rebuilds the same inputs in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.functions.arrays import pin
from spanforge.functions.hashing import draw_index, flipped, u32
from spanforge.schemas import CLASS_NAMES
from spanforge.session import table

SEED = 42
# sent_id = doc_id * factor + line_no: a text has fewer lines than bytes, and a
# string cell fewer bytes than this, so ids of two documents never meet
LINE_KEY_FACTOR = 1 << 31

# FIXED VALUES — gazetteer phrases (frequent function words of the corpus
# languages), each with the class it stands for in the tests.
FIXED_PHRASES = [
    ("der", "Medikation"),
    ("the", "Medikation"),
    ("de la", "Medikation"),
    ("und", "Dosis"),
    ("of the", "Dosis"),
    ("et", "Dosis"),
    ("in den", "Diagnose"),
    ("la", "Diagnose"),
    ("que", "Diagnose"),
]


def asked_partitions(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A session may ask for a number of partitions (``spanforge.scanPartitions``) where
    its files are unsplittable, as a test file of one row group is."""
    parts = spark.conf.get("spanforge.scanPartitions", None)
    return df.repartition(int(parts)) if parts else df


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per non-empty line of every document: doc_id, line_no, sent_id, sentence."""
    docs = asked_partitions(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    # outer generators everywhere: a plain one makes Catalyst infer and push a
    # size(...) > 0 filter that re-evaluates the array expression
    s = docs.select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "sentence"))
    s = s.where(F.col("sentence") != "")
    return s.withColumn("sent_id", F.col("doc_id") * LINE_KEY_FACTOR + F.col("line_no"))


def split_of(key) -> F.Column:
    """Deterministic 80/10/10 split from the key hash."""
    b = draw_index(10, SEED, key, "split")
    return F.when(b < 8, "train").when(b == 8, "validation").otherwise("test")


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gazetteer: fixed function words plus part names (Medikation) and part
    types (Dosis) and nation names (Diagnose) from the tables; distinct."""
    fixed = spark.createDataFrame(FIXED_PHRASES, "phrase string, label string")
    part = table(spark, sf_dir, "part")
    nation = table(spark, sf_dir, "nation")
    derived = (part.select(F.col("p_name").alias("phrase"), F.lit("Medikation").alias("label"))
               .unionByName(part.select(F.col("p_type").alias("phrase"), F.lit("Dosis").alias("label")))
               .unionByName(nation.select(F.col("n_name").alias("phrase"), F.lit("Diagnose").alias("label"))))
    return fixed.unionByName(derived).where(F.col("phrase").isNotNull()).distinct()


def random_char_spans(df: DataFrame, key: str = "sent_id", text: str = "sentence",
                      max_spans: int = 3, max_len: int = 12) -> DataFrame:
    """Add ``spans: array<struct<start,stop,ner_class,ord>>`` — 1..max_spans
    hash-drawn character spans clipped to the text (they overlap and cut
    tokens, which exercises G2/G3)."""
    n = F.length(text)
    k = draw_index(max_spans, SEED, F.col(key), "k") + 1
    spans = F.transform(F.sequence(F.lit(0), k - 1), lambda s: F.struct(
        draw_index(n, SEED, F.col(key), s, "a").alias("start"),
        F.least(draw_index(n, SEED, F.col(key), s, "a") + draw_index(max_len, SEED, F.col(key), s, "b") + 1,
                n).alias("stop"),
        draw_index(3, SEED, F.col(key), s, "c").alias("ner_class"),
        s.alias("ord")))
    return df.withColumn("spans", pin(spans))


def labelled_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 rows (sentence, ner_labels struct of lists sorted by start) + split."""
    s = random_char_spans(sentences(spark, sf_dir))
    srt = F.array_sort("spans")
    return s.select(
        "doc_id", "line_no", "sent_id", "sentence",
        F.struct(F.transform(srt, lambda x: x["ner_class"]).alias("ner_class"),
                 F.transform(srt, lambda x: x["start"]).alias("start"),
                 F.transform(srt, lambda x: x["stop"]).alias("stop")).alias("ner_labels"),
        split_of(F.col("doc_id")).alias("split"))


def class_name_literal():
    return F.array(*[F.lit(c) for c in CLASS_NAMES])


def flip_tags(tags, key, seed: int = SEED, rate: float = 0.1, n_tags: int = 7):
    """Predicted tags = gold tags with hash-drawn replacements (rate ``rate``)."""
    return flipped(tags, seed, key, rate, n_tags)


__all__ = ["sentences", "phrases", "labelled_sentences", "random_char_spans", "split_of", "draw_index",
           "flip_tags", "u32", "SEED"]


# --- lexicon sources (code lists, dose list, term list) ----------------------

def pipe_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pipe-separated code-list lines built from ``part``: code in field 5,
    padded term in field 7; every 10th-by-hash line has only 7 fields and
    every 13th-by-hash code is blank."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    code = F.when(draw_index(13, SEED, k, "blank") == 0, F.lit("  ")).otherwise(F.concat(F.lit("C"), k.cast("string")))
    fields = [k.cast("string"), F.col("p_type"), F.col("p_size").cast("string"), F.col("p_brand"), F.lit("A"),
              code, F.col("p_size").cast("string"), F.concat(F.lit(" "), F.col("p_name"), F.lit(" "))]
    short = draw_index(10, SEED, k, "short") == 0
    line = F.when(short, F.concat_ws("|", *fields[:7])).otherwise(F.concat_ws("|", *fields))
    return p.select(k.alias("line_key"), line.alias("value"))


def semicolon_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ``;`` code-list lines from ``part``: terminal flag in field 1 (T/N by
    hash), code in field 5, term in field 8; every 10th-by-hash line has 8 fields."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    flag = F.when(draw_index(3, SEED, k, "flag") == 0, F.lit("N")).otherwise(F.lit("T"))
    flag = F.when(draw_index(4, SEED, k, "pad") == 0, F.concat(F.lit(" "), flag, F.lit("\t"))).otherwise(flag)
    fields = [k.cast("string"), flag, F.col("p_brand"), F.col("p_type"), F.col("p_size").cast("string"),
              F.concat(F.lit("D"), k.cast("string")), F.lit("x"), F.lit("y"), F.col("p_name")]
    short = draw_index(10, SEED, k, "short") == 0
    line = F.when(short, F.concat_ws(";", *fields[:8])).otherwise(F.concat_ws(";", *fields))
    return p.select(k.alias("line_key"), line.alias("value"))


def dose_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dose list as raw strings (what a CSV file holds): pandas NA tokens
    (``NA``, empty, ``null``) planted by hash in ``ddd`` and ``uom``."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    dd = draw_index(7, SEED, k, "ddd")
    ddd = (F.when(dd == 0, F.lit("NA")).when(dd == 1, F.lit(""))
           .otherwise(F.concat(F.col("p_size").cast("string"), F.lit("."), (F.pmod(k, F.lit(4)) * 25).cast("string"))))
    du = draw_index(5, SEED, k, "uom")
    units = F.array(*[F.lit(u) for u in ["mg", "ug", "g", "ml", "IE"]])
    uom = F.when(du == 0, F.lit("null")).otherwise(F.get(units, draw_index(5, SEED, k, "unit")))
    return p.select(F.concat(F.lit("A"), k.cast("string")).alias("atc_code"), F.col("p_name").alias("atc_name"),
                    ddd.alias("ddd"), uom.alias("uom"), F.lit("O").alias("adm_r"), F.lit("").alias("note"))


def term_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code/term list rows (ICD_Code, Diagnose) from ``part``; some terms carry
    ``;`` and ``"`` so quoting is exercised."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    term = F.when(draw_index(9, SEED, k, "q") == 0, F.concat(F.col("p_name"), F.lit('; "Typ" B'))).otherwise(F.col("p_name"))
    return p.select(F.concat(F.lit("I"), k.cast("string")).alias("ICD_Code"), term.alias("Diagnose"))


def entity_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences + requested entities: the texts under the hash-drawn spans,
    a repeat of the first one for every 4th-by-hash sentence and a term that
    never occurs for every 10th-by-hash sentence."""
    s = random_char_spans(sentences(spark, sf_dir))
    names = class_name_literal()
    ents = F.transform("spans", lambda x: F.struct(
        F.substring("sentence", x["start"] + 1, x["stop"] - x["start"]).alias("text"),
        F.get(names, x["ner_class"]).alias("label")))
    dup = F.when(draw_index(4, SEED, F.col("sent_id"), "dup") == 0, F.slice(ents, 1, 1)).otherwise(F.slice(ents, 1, 0))
    miss = F.when(draw_index(10, SEED, F.col("sent_id"), "miss") == 0,
                  F.array(F.struct(F.lit("zzqx").alias("text"), F.lit("Diagnose").alias("label")))
                  ).otherwise(F.slice(ents, 1, 0))
    return s.select("sent_id", "sentence", F.concat(ents, dup, miss).alias("entities"))


def tagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inline-tagged sentences from ``part`` and ``nation`` values."""
    p = table(spark, sf_dir, "part")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey"), F.col("n_name"))
    k = F.col("p_partkey")
    nk = F.pmod(k, F.lit(25)).cast("int")
    j = p.join(n, nk == F.col("n_nationkey"), "left")
    med = F.concat(F.lit('<class="Medikation">'), F.col("p_name"), F.lit("</class>"))
    dose = F.concat(F.lit('<class="Dosis">'), F.col("p_size").cast("string"), F.lit(" mg</class>"))
    diag = F.concat(F.lit('<class="Diagnose">'), F.col("n_name"), F.lit("</class>"))
    v = draw_index(3, SEED, k, "tag")
    body = (F.when(v == 0, F.concat(F.lit("Patient erhält "), med, F.lit(" "), dose, F.lit(" wegen "), diag, F.lit(".")))
            .when(v == 1, F.concat(dose, F.lit(" "), med, F.lit("/"), med, F.lit(" 1-0-0")))
            .otherwise(F.concat(F.lit("Befund: "), diag, F.lit(" ohne Therapie."))))
    return j.select(k.alias("line_key"), F.concat(F.lit("<s>"), body, F.lit("</s>")).alias("value"))
