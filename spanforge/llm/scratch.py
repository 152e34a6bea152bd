"""Tables that cut lineage: written under the cluster's shared checkpoint folder."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spanforge.session import ensure_checkpoint_dir

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, deleted when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a scratch Parquet table and read it back.  Executors may be
    lost afterwards; the files are in the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete scratch tables that no later plan reads."""
    for t in tables:
        spark = t.sparkSession
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def row_key(seed: int) -> Column:
    """Half of a 128-bit key of (doc_id, text), nulls told from values."""
    return F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")


def give_back() -> None:
    """Return freed memory to the machine: a Python worker serves many stages, and what
    one of them freed would count against the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes, as texts may be long: a session
    that still has the default (64 MB) gets 4 MB."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH) in ("67108864b", "67108864", "64m", "64MB"):
        conf.set(_BATCH, "4m")

    def whole(batches):
        yield from run(batches)
        give_back()

    return df.mapInArrow(whole, schema)
