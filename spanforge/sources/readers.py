"""Readers (A1–A8): every format is read by Spark's own scanners with an
explicit schema; no Python parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.functions.text import ustrip
from spanforge.schemas import DOSE_CSV, LABELLED_SENTENCE

# pandas' default missing-value tokens (``pd.read_csv`` na_values)
PANDAS_NA = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_jsonl_corpus(spark: SparkSession, path: str, schema=LABELLED_SENTENCE) -> DataFrame:
    """A1: JSON Lines corpus; blank lines skipped; a malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A2: a split dataset written with ``partitionBy('split')``; choosing a
    split prunes the other partitions' files."""
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df


def read_terms_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A3: ``;``-separated CSV with header, UTF-8 BOM tolerated, all columns strings."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    df = (spark.read.option("sep", ";").option("header", True).option("quote", '"').option("escape", '"')
          .option("encoding", "UTF-8").schema(schema).csv(path))
    return df


def read_dose_csv(spark: SparkSession, path: str, schema=DOSE_CSV) -> DataFrame:
    """A4: comma CSV with header; pandas NA tokens become NULL, ``ddd`` is numeric (under
    ANSI mode a malformed number fails the job)."""
    raw_schema = ", ".join(f"`{f.name}` string" for f in schema.fields)
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"').schema(raw_schema).csv(path)
    cols = []
    for f in schema.fields:
        c = F.when(F.col(f.name).isin(*PANDAS_NA) | F.col(f.name).isNull(), F.lit(None)).otherwise(F.col(f.name))
        cols.append(c.cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def split_fields(lines: DataFrame, sep_regex: str, value: str = "value") -> DataFrame:
    """Strip CR/LF and split a raw line into all its fields (trailing empties kept)."""
    v = F.regexp_replace(F.col(value), F.lit("[\r\n]+$"), F.lit(""))
    return lines.withColumn("fields", F.split(v, sep_regex, -1))


def extract_codes(lines: DataFrame, sep_regex: str, min_fields: int, code_idx: int, term_idx: int,
                  flag_idx: int | None = None, flag_value: str | None = None) -> DataFrame:
    """A5/A6 (+B9, B10): width guard, optional terminal-flag filter, pick and
    trim the code and term fields, keep rows where both are non-empty.

    Returns every line with ``status`` in {kept, too_few, not_terminal, empty}
    so rejects can be counted in the same pass (A7)."""
    df = split_fields(lines, sep_regex)
    n = F.size("fields")
    code = ustrip(F.get(F.col("fields"), code_idx))
    term = ustrip(F.get(F.col("fields"), term_idx))
    status = F.when(n < min_fields, "too_few")
    if flag_idx is not None:
        status = status.when(ustrip(F.get(F.col("fields"), flag_idx)) != F.lit(flag_value), "not_terminal")
    status = status.when((code == "") | (term == ""), "empty").otherwise("kept")
    return df.select("*", F.when(n >= min_fields, code).alias("code"), F.when(n >= min_fields, term).alias("term"),
                     status.alias("status")).drop("fields")


def read_json_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON array of strings -> one row per string."""
    docs = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
    arr = F.from_json("value", "array<string>")
    return docs.select(F.posexplode_outer(arr).alias("pos", "value")).where(F.col("pos").isNotNull()).select("value")
