"""The lexicon table (A9, C9): one written table (source, label, idx, n, term) that
generation draws from.

``idx`` counts the terms of a source and label from 0 in a total order (duplicates are
kept: they weight draws), ``n`` is their number.  Writing is the ETL step; what reads
the table (a draw's modulus, a lookup) is part of the reader's plan.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.operators.sampling import dense_index
from spanforge.session import ensure_checkpoint_dir


def write_lexicon(terms: DataFrame, path: str, order: list[str]) -> None:
    """``(source, label, term, *order)`` -> the table at ``path``.  The index is the
    place in a distributed sort, less the first place of the source and label."""
    placed = dense_index(terms, ["source", "label", *order]).withColumnRenamed("idx", "at")
    groups = placed.groupBy("source", "label").agg(F.min("at").alias("first"), F.count("*").cast("int").alias("n"))
    (placed.join(F.broadcast(groups), ["source", "label"])           # a row per source and label
     .select("source", "label", (F.col("at") - F.col("first")).cast("int").alias("idx"), "n", "term")
     .write.mode("overwrite").parquet(path))


def stored_lexicon(spark: SparkSession, tables: list[str], terms, order: list[str]) -> DataFrame:
    """The table made by ``terms()`` from the given files, written once for their present
    state into the shared checkpoint folder: whoever finds it complete reads it."""
    conf, hadoop = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs
    state = "|".join(f"{t}:{s.getModificationTime()}:{s.getLen()}" for t in tables
                     for p in [hadoop.Path(t)] for s in [p.getFileSystem(conf).getFileStatus(p)])
    name = hashlib.sha256(f"{spark.sparkContext.applicationId}|{state}".encode()).hexdigest()[:24]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/spanforge-lexicon-{name}"
    done = hadoop.Path(f"{path}/_SUCCESS")
    fs = done.getFileSystem(conf)
    if not fs.exists(done):
        write_lexicon(terms(), path, order)
        fs.deleteOnExit(hadoop.Path(path))
    return spark.read.schema("source string, label string, idx int, n int, term string").parquet(path)


def size_of(lexicon: DataFrame, source: str, label: str):
    """The number of terms of a source and label, as a scalar subquery."""
    return lexicon.where((F.col("source") == source) & (F.col("label") == label) & (F.col("idx") == 0)).select("n").scalar()
