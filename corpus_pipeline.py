"""The corpus pipeline: toxicity, SimHash near-dedup, substring dedup, PII, packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written as Parquet and read again as the next
one's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from spanforge.llm.packing import pack_documents
from spanforge.llm.pii import sanitise
from spanforge.llm.scratch import materialise
from spanforge.llm.simhash import one_per_group
from spanforge.llm.substring import without_repeats
from spanforge.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go.  Learns from the labels that op1 learns from."""
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").filter(part != 0))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return one_per_group(docs, shingle=4, max_bits=4)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a 35-word passage that occurs elsewhere too go."""
    return without_repeats(docs, length=35)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and words that disclose it are generalised or removed."""
    return sanitise(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every text in their bins."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("simhash", simhash), ("substring", substring), ("pii", pii), ("packing", packing)]

#: toxicity learns a model, simhash needs XXH64, pii and packing are no SQL either
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
