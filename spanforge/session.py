"""Session helpers: a tuned local/cluster session, table loading, lineage cuts."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "spanforge", driver_memory: str | None = "8g") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle-partition count then comes from the cluster config unless given.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        if driver_memory:  # local mode: the driver JVM is the executor
            b = b.config("spark.driver.memory", driver_memory)
    spark = (
        b.config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # paid / non-idempotent model calls must never run twice concurrently
        .config("spark.speculation", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object-store) folder there.  Where it is unset, a
    scratch folder is made for a ``local`` master (tests) and deleted at the end; any
    other master would write it on each machine's own disk, so that raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        d = tempfile.mkdtemp(prefix="spanforge-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss; never ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_scratch(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back; the
    folder goes when the application ends."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"spanforge-{name}-{uuid.uuid4().hex}")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 4 MB where the session still has Spark's default of 64 MB, for
    what is made of a batch at once is a multiple of it."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") in ("67108864b", "67108864", "64m", "64MB"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
