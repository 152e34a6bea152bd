"""Structured Streaming corpus preparation.

The corpus steps (A1 -> G1 -> G2 -> G3) are row-local expressions, so the same
operators run unchanged on a stream: new JSONL corpus files arriving in a
folder are tokenised, aligned and de-overlapped, and appended to a Parquet
token corpus.  Exactly-once comes from the file sink plus a checkpoint under
the shared ``spark.checkpoint.dir``; a restarted query resumes from it.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.functions.arrays import pin
from spanforge.operators import spans, tokens
from spanforge.schemas import CLASS_NAMES, LABELLED_SENTENCE
from spanforge.session import ensure_checkpoint_dir

CORPUS_SCHEMA = T.StructType([T.StructField("sent_id", T.LongType())] + LABELLED_SENTENCE.fields
                             + [T.StructField("split", T.StringType())])


def token_corpus_rows(df: DataFrame) -> DataFrame:
    """Labelled sentences -> token corpus rows (G4), valid on batch and stream."""
    t = tokens.tokenize(df)
    names = F.array(*[F.lit(c) for c in CLASS_NAMES])
    z = F.arrays_zip(F.col("ner_labels.ner_class").alias("c"), F.col("ner_labels.start").alias("s"),
                     F.col("ner_labels.stop").alias("e"))
    al = F.transform(z, lambda x: spans.align_expand(F.col("tokens"), x["s"], x["e"])
                     .withField("label", F.get(names, x["c"])))
    al = F.filter(al, lambda a: a.isNotNull())
    return t.select("sent_id", "split", pin(spans.filter_spans(al)).alias("ents"))


def start_token_corpus_stream(spark: SparkSession, in_dir: str, out_dir: str, name: str = "token_corpus",
                              available_now: bool = True):
    """Start the streaming job; returns the StreamingQuery."""
    ckpt = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    src = spark.readStream.schema(CORPUS_SCHEMA).option("maxFilesPerTrigger", 64).json(in_dir)
    out = token_corpus_rows(src)
    w = (out.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", ckpt)
         .partitionBy("split").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def start_component_stream(spark: SparkSession, components: Callable[[DataFrame], DataFrame], in_dir: str, schema: str,
                           out_dir: str, name: str, columns: list[str], available_now: bool = True):
    """Put every text of the JSONL files arriving in ``in_dir`` through a chain of
    components (``operators.pipeline.Pipeline`` or any function of a DataFrame that only
    works within rows) and append ``columns`` to Parquet at ``out_dir``; returns the
    StreamingQuery.

    Progress is checkpointed under ``name``: started again after a stop or a crash, the
    stream goes on with the files it hasn't finished, and the file sink's log keeps a
    file's rows from being counted twice.  A text file without rows gives none."""
    ckpt = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).json(in_dir)
    w = (components(src).select(*columns).writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", ckpt).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
