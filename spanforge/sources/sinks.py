"""Sinks (A10–A14), all written by Spark's own writers into a shared folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.session import ensure_checkpoint_dir

BOM = "\ufeff"
#: files that a task of ``write_corpus`` has open at most
OPEN_SPLITS = 8


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir`` (never a
    machine-local temp folder on a cluster)."""
    path = os.path.join(ensure_checkpoint_dir(spark), "spanforge-io", f"{name}-{uuid.uuid4().hex[:12]}")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    # removed when the application ends
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def write_terms_csv(df: DataFrame, path: str, bom: bool = True) -> None:
    """A10: ``;`` CSV, header, minimal quoting with ``"``; the first header name
    carries U+FEFF so the file starts with a UTF-8 BOM like ``utf-8-sig``."""
    if bom:
        first = df.columns[0]
        df = df.withColumnRenamed(first, BOM + first)
    (df.write.mode("overwrite").option("sep", ";").option("header", True).option("quote", '"')
     .option("escape", '"').option("quoteAll", False).csv(path))


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON Lines, UTF-8, non-ASCII kept unescaped."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_corpus(df: DataFrame, path: str, split_col: str = "split") -> None:
    """Columnar corpus partitioned by split (pruned on read).

    A task keeps a file open for each of the few splits; else it would sort its rows, and
    spill whole token arrays, to have one file open at a time.  More than ``OPEN_SPLITS``
    splits are sorted."""
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, OPEN_SPLITS)
    try:
        df.write.mode("overwrite").partitionBy(split_col).parquet(path)
    finally:
        conf.set(key, before)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int | None = None) -> DataFrame:
    """A13 for joins by ``key``: a table of ``buckets`` files (default: the session's
    shuffle partitions), each holding all rows of its keys, sorted by them.

    The rows are shuffled once, by the writer's own hash, so a bucket is one file; every
    later join or grouping by ``key`` of tables with as many buckets needs no exchange.
    ``name`` stays in the catalog for later readers; the files lie at ``path``."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def write_metrics(df: DataFrame, path: str) -> None:
    """Metric rows as JSON, in as many files as the plan has partitions (an
    aggregate of few rows has one after adaptive coalescing)."""
    df.write.mode("overwrite").json(path)


def write_lines(df: DataFrame, path: str, col: str = "value") -> None:
    df.select(F.col(col).alias("value")).write.mode("overwrite").text(path)
