"""Registered queries: sources and sinks (A), projections and label maps (B)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.functions import labels as L
from spanforge.functions.text import py_float_text
from spanforge.operators import lexicon
from spanforge.operators.sampling import seeded_shuffle
from spanforge.plans import bindings as B
from spanforge.plans import oracle as O
from spanforge.plans.registry import query
from spanforge.schemas import CLASS_NAMES, LABELLED_SENTENCE
from spanforge.session import table
from spanforge.sources import readers, sinks


def joined(c):
    return F.coalesce(F.array_join(c.cast("array<string>"), ","), F.lit(""))


def flat_labelled(df):
    nl = F.col("ner_labels")
    return df.select("sent_id", "sentence", joined(nl["ner_class"]).alias("ner_class"),
                     joined(nl["start"]).alias("start"), joined(nl["stop"]).alias("stop"))


def _lab():
    return O.with_(O.SENTENCES, O.RAW_SPANS, O.LABELLED)


# --- A: sources and sinks ------------------------------------------------------

def _jsonl_roundtrip(spark, d):
    ls = B.labelled_sentences(spark, d).select("sent_id", "sentence", "ner_labels")
    path = sinks.scratch_path(spark, "jsonl")
    sinks.write_jsonl(ls, path)
    schema = T.StructType([T.StructField("sent_id", T.LongType())] + LABELLED_SENTENCE.fields)
    return readers.read_jsonl_corpus(spark, path, schema)


@query("scan_jsonl", lambda: _lab() + "SELECT sent_id, sentence, ner_class, start, stop FROM labelled")
def scan_jsonl(spark, d):
    """A1: JSON Lines corpus read with an explicit schema (FAILFAST)."""
    return flat_labelled(_jsonl_roundtrip(spark, d))


@query("sink_jsonl", lambda: _lab() + "SELECT sent_id, sentence, ner_class, start, stop FROM labelled")
def sink_jsonl(spark, d):
    """JSONL writer, checked by reading the files back."""
    return flat_labelled(_jsonl_roundtrip(spark, d))


def _corpus_roundtrip(spark, d):
    path = sinks.scratch_path(spark, "corpus")
    sinks.write_corpus(B.labelled_sentences(spark, d), path)
    return path


@query("scan_split", lambda: _lab() + "SELECT sent_id, sentence, ner_class, start, stop FROM labelled "
       "WHERE split = 'validation'")
def scan_split(spark, d):
    """A2: read one split of a split-partitioned corpus (partition pruning)."""
    return flat_labelled(readers.read_split(spark, _corpus_roundtrip(spark, d), "validation"))


@query("sink_corpus", lambda: _lab() + "SELECT sent_id, split, ner_class, start, stop FROM labelled")
def sink_corpus(spark, d):
    """Columnar corpus directory partitioned by split, read back whole."""
    df = readers.read_split(spark, _corpus_roundtrip(spark, d))
    nl = F.col("ner_labels")
    return df.select("sent_id", "split", joined(nl["ner_class"]).alias("ner_class"),
                     joined(nl["start"]).alias("start"), joined(nl["stop"]).alias("stop"))


def _terms_roundtrip(spark, d):
    path = sinks.scratch_path(spark, "terms")
    sinks.write_terms_csv(B.term_rows(spark, d), path)
    return readers.read_terms_csv(spark, path, ["ICD_Code", "Diagnose"])


@query("scan_terms_csv", lambda: O.with_(O.TERMS) + "SELECT ICD_Code, Diagnose FROM terms")
def scan_terms_csv(spark, d):
    """A3: ``;`` CSV with header and BOM, every column a string."""
    return _terms_roundtrip(spark, d)


@query("sink_terms_csv", lambda: O.with_(O.TERMS) + "SELECT ICD_Code, Diagnose, "
       "true AS all_files_bom FROM terms")
def sink_terms_csv(spark, d):
    """A10: ``;`` CSV writer with BOM + minimal quoting; the read-back rows and
    a check that every written part file begins with U+FEFF."""
    path = sinks.scratch_path(spark, "terms")
    sinks.write_terms_csv(B.term_rows(spark, d), path)
    rows = readers.read_terms_csv(spark, path, ["ICD_Code", "Diagnose"])
    # one small action over the part files' first bytes (text readers drop a
    # leading BOM, so look at the raw bytes)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
             .select((F.hex(F.substring("content", 1, 3)) == "EFBBBF").alias("bom")))
    all_bom = files.agg(F.bool_and("bom")).first()[0]
    return rows.withColumn("all_files_bom", F.lit(bool(all_bom)))


def _dose(spark, d):
    path = sinks.scratch_path(spark, "dose")
    B.dose_rows(spark, d).write.mode("overwrite").option("header", True).csv(path)
    return readers.read_dose_csv(spark, path)


@query("scan_dose_csv", lambda: O.with_(O.DOSE) + "SELECT atc_code, atc_name, ddd, uom, adm_r, note FROM dose")
def scan_dose_csv(spark, d):
    """A4: comma CSV, numeric ``ddd``, pandas NA tokens -> NULL."""
    return _dose(spark, d)


def _lines(spark, d, binding, name):
    path = sinks.scratch_path(spark, name)
    sinks.write_lines(binding(spark, d).select(F.concat_ws("\t", "line_key", "value").alias("value")), path)
    raw = spark.read.text(path)
    parts = F.split("value", "\t", 2)
    return raw.select(parts.getItem(0).cast("bigint").alias("line_key"), parts.getItem(1).alias("value"))


def _alpha(spark, d):
    return readers.extract_codes(_lines(spark, d, B.pipe_lines, "pipe"), "[|]", 8, 5, 7)


def _terminal(spark, d):
    return readers.extract_codes(_lines(spark, d, B.semicolon_lines, "semi"), ";", 9, 5, 8, 1, "T")


@query("extract_alpha_codes", lambda: O.with_(O.PIPE_LINES, O.extract_cte("x", "pipe_lines", "|", 8, 5, 7))
       + "SELECT line_key, code, term FROM x WHERE status = 'kept'")
def extract_alpha_codes(spark, d):
    """A5 (+B9): pipe lines, width guard, fields 5 and 7 trimmed, non-empty."""
    return _alpha(spark, d).where("status = 'kept'").select("line_key", "code", "term")


@query("extract_terminal_codes", lambda: O.with_(O.SEMI_LINES, O.extract_cte("x", "semi_lines", ";", 9, 5, 8, 1))
       + "SELECT line_key, code, term FROM x WHERE status = 'kept'")
def extract_terminal_codes(spark, d):
    """A6 (+B10): ``;`` lines, width guard, terminal rows only, fields 5 and 8."""
    return _terminal(spark, d).where("status = 'kept'").select("line_key", "code", "term")


@query("code_reject_counts", lambda: O.with_(O.PIPE_LINES, O.SEMI_LINES,
                                             O.extract_cte("a", "pipe_lines", "|", 8, 5, 7),
                                             O.extract_cte("t", "semi_lines", ";", 9, 5, 8, 1))
       + "SELECT 'alpha' AS source, status, count(*)::BIGINT AS n FROM a GROUP BY status "
       "UNION ALL SELECT 'terminal', status, count(*)::BIGINT FROM t GROUP BY status")
def code_reject_counts(spark, d):
    """Kept / too-few-fields / non-terminal / empty counts in one pass."""
    a = _alpha(spark, d).groupBy("status").agg(F.count("*").alias("n")).withColumn("source", F.lit("alpha"))
    t = _terminal(spark, d).groupBy("status").agg(F.count("*").alias("n")).withColumn("source", F.lit("terminal"))
    return a.unionByName(t).select("source", "status", "n")


@query("code_reject_lines", lambda: O.with_(O.PIPE_LINES, O.SEMI_LINES,
                                            O.extract_cte("a", "pipe_lines", "|", 8, 5, 7),
                                            O.extract_cte("t", "semi_lines", ";", 9, 5, 8, 1))
       + "SELECT 'alpha' AS source, line_key, status FROM a WHERE status <> 'kept' "
       "UNION ALL SELECT 'terminal', line_key, status FROM t WHERE status <> 'kept'")
def code_reject_lines(spark, d):
    """The numbers of the skipped lines, with the reason."""
    rows = [df.where("status <> 'kept'").select(F.lit(name).alias("source"), "line_key", "status")
            for name, df in (("alpha", _alpha(spark, d)), ("terminal", _terminal(spark, d)))]
    return rows[0].unionByName(rows[1])


@query("nonempty_terms", lambda: O.with_(O.PIPE_LINES, O.extract_cte("a", "pipe_lines", "|", 8, 5, 7))
       + "SELECT line_key, code, term, status FROM a WHERE status IN ('kept', 'empty')")
def nonempty_terms(spark, d):
    """Trim (Unicode whitespace) and keep only rows with both fields non-empty;
    the rejected 'empty' rows are reported next to the kept ones."""
    return _alpha(spark, d).where("status IN ('kept', 'empty')").select("line_key", "code", "term", "status")


@query("scan_json_array", lambda: "SELECT p_name AS value FROM part")
def scan_json_array(spark, d):
    """Files each holding one JSON array of strings -> one row per string.
    The files are written per key bucket of at most 1000 names."""
    path = sinks.scratch_path(spark, "jsonarr")
    p = table(spark, d, "part").select((F.col("p_partkey") / 1000).cast("long").alias("bucket"), "p_name")
    arrays = p.groupBy("bucket").agg(F.to_json(F.collect_list("p_name")).alias("value"))
    arrays.repartition("bucket").write.mode("overwrite").partitionBy("bucket").text(path)
    return readers.read_json_arrays(spark, path)


@query("sink_metrics", lambda: O.with_(*O.scoring_ctes(), O.PRF_FROM_CHUNKS) + O.PRF_SELECT)
def sink_metrics(spark, d):
    """Metric rows written as JSON and read back."""
    from spanforge.plans.scoring import ner_scores
    path = sinks.scratch_path(spark, "metrics")
    sinks.write_metrics(ner_scores(spark, d), path)
    return spark.read.schema("scope string, n_gold long, n_pred long, tp long, precision double, "
                             "recall double, f1 double").json(path)


# --- B: projections, label maps, casts, set operations -------------------------

@query("to_offset_format", lambda: _lab() + "SELECT sent_id, sentence AS text, start AS ent_starts, "
       "stop AS ent_stops, class_names AS ent_classes FROM labelled")
def to_offset_format(spark, d):
    """B1: canonical record -> (text, ent_starts, ent_stops, ent_classes names)."""
    r = lexicon.to_offset_format(B.labelled_sentences(spark, d))
    return r.select("sent_id", "text", joined(F.col("ent_starts")).alias("ent_starts"),
                    joined(F.col("ent_stops")).alias("ent_stops"), joined(F.col("ent_classes")).alias("ent_classes"))


_IDS = "(p_size % 5) - 1"


@query("label_name", lambda: "SELECT p_partkey, (" + _IDS + ")::INTEGER AS class_id, "
       "CASE " + _IDS + " WHEN 0 THEN 'Medikation' WHEN 1 THEN 'Dosis' WHEN 2 THEN 'Diagnose' END AS name FROM part")
def label_name(spark, d):
    """B2: class id -> name, unknown (-1, 3) -> NULL."""
    p = table(spark, d, "part").select("p_partkey", (F.pmod("p_size", F.lit(5)) - 1).cast("int").alias("class_id"))
    return p.select("p_partkey", "class_id", L.class_name(F.col("class_id")).alias("name"))


@query("label_from_schema", lambda: "SELECT p_partkey, (" + _IDS + ")::INTEGER AS class_id, "
       "CASE " + _IDS + " WHEN 0 THEN 'Medikation' WHEN 1 THEN 'Dosis' WHEN 2 THEN 'Diagnose' END AS name FROM part")
def label_from_schema(spark, d):
    """Class names read from the column's schema metadata, then indexed."""
    p = table(spark, d, "part").select(
        "p_partkey", (F.pmod("p_size", F.lit(5)) - 1).cast("int").alias("class_id", metadata={"names": CLASS_NAMES}))
    names = L.names_from_metadata(p.schema["class_id"])
    arr = F.array(*[F.lit(n) for n in names])
    return p.select("p_partkey", "class_id", F.get(arr, F.col("class_id")).alias("name"))


_NAME = "CASE p_size % 4 WHEN 0 THEN 'Medikation' WHEN 1 THEN 'Dosis' WHEN 2 THEN 'Diagnose' ELSE 'Symptom' END"


@query("label_id", lambda: f"SELECT p_partkey, {_NAME} AS name, CASE {_NAME} WHEN 'Medikation' THEN 0 "
       "WHEN 'Dosis' THEN 1 WHEN 'Diagnose' THEN 2 END AS class_id FROM part")
def label_id(spark, d):
    """Class name -> id, unknown ('Symptom') -> NULL."""
    names = F.array(*[F.lit(x) for x in ["Medikation", "Dosis", "Diagnose", "Symptom"]])
    p = table(spark, d, "part").select("p_partkey", F.get(names, F.pmod("p_size", F.lit(4))).alias("name"))
    return p.select("p_partkey", "name", L.class_id(F.col("name")).alias("class_id"))


@query("label_names_array", lambda: _lab() + "SELECT sent_id, class_names FROM labelled")
def label_names_array(spark, d):
    """Array of class ids -> array of names."""
    ls = B.labelled_sentences(spark, d)
    return ls.select("sent_id", joined(L.class_names(F.col("ner_labels.ner_class"))).alias("class_names"))


@query("bio_vocab", lambda: O.with_(*O.scoring_ctes()) +
       "SELECT gold AS tag_id, ['O','B-Medikation','I-Medikation','B-Dosis','I-Dosis','B-Diagnose','I-Diagnose']"
       "[gold + 1] AS tag, gold AS id_back, count(*)::BIGINT AS n FROM both_tags GROUP BY gold")
def bio_vocab(spark, d):
    """BIO id <-> tag both ways, over the gold tags of the corpus."""
    from spanforge.plans.scoring import gold_and_predicted
    t = gold_and_predicted(spark, d).select(F.explode_outer("gold_tags").alias("tag_id")).where("tag_id IS NOT NULL")
    c = t.groupBy("tag_id").agg(F.count("*").alias("n"))
    return c.select("tag_id", L.bio_tag(F.col("tag_id")).alias("tag"),
                    L.bio_id(L.bio_tag(F.col("tag_id"))).alias("id_back"), "n")


@query("dropna_any", lambda: O.with_(O.DOSE) + "SELECT atc_code, atc_name, ddd, uom FROM dose "
       "WHERE ddd IS NOT NULL AND uom IS NOT NULL")
def dropna_any(spark, d):
    """Drop rows with NULL in any of (ddd, uom)."""
    return lexicon.dropna_any(_dose(spark, d), ["ddd", "uom"]).select("atc_code", "atc_name", "ddd", "uom")


@query("dropna_single_count", lambda: O.with_(O.DOSE) +
       "SELECT count(atc_name)::BIGINT AS n_names FROM dose WHERE ddd IS NOT NULL")
def dropna_single_count(spark, d):
    """The effective semantics — drop NULL ``ddd`` from the original, count names."""
    return lexicon.dropna_single_count(_dose(spark, d), "ddd", "atc_name")


@query("lexicon_strings", lambda: O.with_(O.DOSE) + "SELECT atc_code, coalesce(" + O.py_float_sql("ddd")
       + ", 'nan') AS ddd_text, coalesce(uom, 'nan') AS uom_text FROM dose")
def lexicon_strings(spark, d):
    """Project columns to strings; NULL becomes 'nan'; duplicates kept."""
    df = _dose(spark, d)
    return df.select("atc_code", lexicon.as_strings(F.col("ddd"), numeric=True).alias("ddd_text"),
                     lexicon.as_strings(F.col("uom")).alias("uom_text"))


@query("cast_to_schema", lambda: _lab() + "SELECT sent_id, sentence, ner_class, start, stop, "
       "'array<int>' AS class_type FROM labelled")
def cast_to_schema(spark, d):
    """Cast a corpus (64-bit label lists) to the target corpus schema."""
    ls = B.labelled_sentences(spark, d)
    wide = ls.select("sent_id", "sentence", F.col("ner_labels").cast(
        "struct<ner_class:array<bigint>,start:array<bigint>,stop:array<bigint>>").alias("ner_labels"))
    target = T.StructType([T.StructField("sent_id", T.LongType())] + LABELLED_SENTENCE.fields)
    cast = lexicon.cast_to_schema(wide, target)
    return flat_labelled(cast).withColumn(
        "class_type", F.lit(cast.schema["ner_labels"].dataType["ner_class"].dataType.simpleString()))


def _appended(spark, d):
    corpus = B.labelled_sentences(spark, d).select(
        F.col("sent_id").alias("row_key"), "sentence", "split", F.lit(False).alias("synthetic"))
    synth = table(spark, d, "benchmark").select(
        F.col("item_id").alias("row_key"), F.col("text").alias("sentence"), F.lit(True).alias("synthetic"))
    return lexicon.append_to_split(corpus, synth, "train")


@query("append_synthetic_train", lambda: _lab() +
       "SELECT sent_id AS row_key, split, false AS synthetic FROM labelled "
       "UNION ALL SELECT item_id, 'train', true FROM benchmark")
def append_synthetic_train(spark, d):
    """Bag union; synthetic rows go to the train split only."""
    return _appended(spark, d).select("row_key", "split", "synthetic")


@query("split_counts", lambda: _lab() + ", u AS (SELECT split, false AS syn FROM labelled "
       "UNION ALL SELECT 'train', true FROM benchmark) "
       "SELECT split, count(*)::BIGINT AS n_rows, count_if(syn)::BIGINT AS n_synthetic, "
       "(count(*) - count_if(syn))::BIGINT AS n_before FROM u GROUP BY split")
def split_counts(spark, d):
    """B14 (+J14): rows per split before and after the synthetic append."""
    return lexicon.split_counts(_appended(spark, d))


_DESCRIBED = (("sentence", "sentence", "length(sentence)"), ("ner_labels", "ner_class", "len(string_split(ner_class, ','))"))


def _describe_sql():
    parts = [f"SELECT split, '{name}' AS name, count(*)::BIGINT AS n_rows, (count(*) - count({col}))::BIGINT AS n_null, "
             f"min({size})::DOUBLE AS minimum, max({size})::DOUBLE AS maximum, round(avg({size}), 6) AS mean, "
             f"quantile_disc({size}, 0.5)::DOUBLE AS median, quantile_disc({size}, 0.9)::DOUBLE AS p90, "
             + " || ',' || ".join(f"count_if({cond})::VARCHAR" for cond in
                                  [f"{size} < 1"] + [f"{size} >= {a} AND {size} < {b}" for a, b in
                                                     ((1, 10), (10, 100), (100, 1000), (1000, 10000))] + [f"{size} >= 10000"])
             + " AS histogram FROM u GROUP BY split" for name, col, size in _DESCRIBED]
    return (_lab() + ", u AS (SELECT split, sentence, ner_class FROM labelled "
            "UNION ALL SELECT 'train', text, NULL FROM benchmark) " + " UNION ALL ".join(parts))


@query("describe_splits", _describe_sql)
def describe_splits(spark, d):
    """Rows, nulls, lengths (range, mean, median, 90 %, histogram) of sentences and
    label lists per split of the appended corpus; the distinct counts are estimates, so
    they are held against exact counts in a test instead."""
    labelled = B.labelled_sentences(spark, d).select("sentence", "ner_labels", "split")
    u = lexicon.append_to_split(labelled, table(spark, d, "benchmark").select(F.col("text").alias("sentence")), "train")
    # a rank error below one row for up to a million rows a split
    r = lexicon.describe_splits(u, {"sentence": F.col("sentence"), "ner_labels": F.col("ner_labels.ner_class")},
                                accuracy=1_000_000)
    return r.drop("n_distinct").withColumn("histogram", F.array_join("histogram", ","))


@query("head_k", lambda: _lab() + "SELECT sent_id, sentence FROM labelled ORDER BY sent_id LIMIT 5")
def head_k(spark, d):
    """First k rows by key (top-k, not a full sort)."""
    return B.labelled_sentences(spark, d).orderBy("sent_id").limit(5).select("sent_id", "sentence")


@query("seeded_shuffle", lambda: _lab() + "SELECT sent_id, md5(concat_ws('|', 42, sent_id)) AS shuffle_key "
       "FROM labelled ORDER BY shuffle_key, sent_id")
def q_seeded_shuffle(spark, d):
    """Seeded global shuffle, stable under any partitioning."""
    return seeded_shuffle(B.labelled_sentences(spark, d), "sent_id", 42).select("sent_id", "shuffle_key")
