"""Bulk model calls and response handling.

E1 is the only Python step: ``mapInPandas`` runs a user-supplied callable,
building its client once per task.  Everything after the raw text — fence
stripping, strict JSON acceptance, span finding, rejects, first-N — is SQL.
``llm_map_once`` keeps the raw responses in a ledger, so neither a task retry nor a
second run pays for a call again.
"""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.functions.arrays import pin
from spanforge.functions.bitmaps import bitmap_of, cannot_be_in, may_be_in
from spanforge.functions.text import strip_fence
from spanforge.operators.sampling import dense_index
from spanforge.operators.spans import find_spans_next, has_unmatched, spans_to_labels
from spanforge.schemas import BASE_DELAY_S, MAX_ATTEMPTS, RESPONSE_JSON, RETRYABLE_CODES
from spanforge.session import write_scratch


class CallError(Exception):
    """An API failure carrying an HTTP-like status ``code``."""

    def __init__(self, code: int, msg: str = ""):
        super().__init__(msg or f"status {code}")
        self.code = code


@dataclass(frozen=True)
class Outcome:
    """What a prompt came to: text or error, after so many attempts."""

    text: str | None
    attempts: int
    code: int | None
    error: str | None


def waits(max_attempts: int, base_delay: float, jitter: Callable[[], float]) -> Iterator[float]:
    """The pauses between attempts, doubling from ``base_delay``, each with jitter."""
    return (base_delay * 2.0 ** k + jitter() for k in range(max_attempts - 1))


def ask(call: Callable[[str, str, int], str], prompt: str, system: str, max_attempts: int = MAX_ATTEMPTS,
        base_delay: float = BASE_DELAY_S, retryable=RETRYABLE_CODES,
        sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random) -> Outcome:
    """Ask until an answer, a code that isn't worth a retry, or the last attempt.

    ``call`` gets the prompt, the system instruction and the attempt's number."""
    pauses = waits(max_attempts, base_delay, jitter)
    attempt = 1
    while True:
        try:
            return Outcome(call(prompt, system, attempt), attempt, 200, None)
        except Exception as failure:  # noqa: BLE001 - reported in the row
            last = Outcome(None, attempt, getattr(failure, "code", None), str(failure))
        pause = next(pauses, None) if last.code in retryable else None
        if pause is None:
            return last
        sleep(pause)
        attempt += 1


def llm_map(df: DataFrame, prompt_col: str, client_factory: Callable[[], Callable[[str, str, int], str]],
            key_cols: list[str], system: str, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Prompt and system instruction -> raw response for every row, Arrow-batched.

    ``client_factory`` is called once per task (not per row).  Output: keys, raw,
    attempts, call_status (the API code), call_error."""
    out_schema = (", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*key_cols).schema.fields)
                  + ", raw string, attempts int, call_status int, call_error string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = None
        for pdf in batches:
            if not len(pdf):
                continue
            call = call or client_factory()          # a task without rows needs no client
            got = [ask(call, p, system, sleep=sleep) for p in pdf[prompt_col]]
            yield pdf[key_cols].assign(raw=[o.text for o in got], attempts=[o.attempts for o in got],
                                       call_status=pd.array([o.code for o in got], dtype="Int32"),
                                       call_error=[o.error for o in got])

    return df.select(*key_cols, prompt_col).mapInPandas(run, out_schema)


def prompt_key(prompt: Column, system: str) -> Column:
    """What an answer belongs to: the prompt under its system instruction."""
    return F.sha2(F.concat_ws("\x00", F.lit(system), prompt), 256)


def llm_map_once(df: DataFrame, prompt_col: str, client_factory: Callable[[], Callable[[str, str, int], str]],
                 key_cols: list[str], system: str, ledger: str, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """E1 over a ledger: every distinct prompt is paid for once, whatever gets lost.

    ``ledger`` is a folder of answered prompts that only grows.  Prompts that it doesn't
    hold yet are asked and appended; a task's answers are in the ledger as soon as the
    task ends (its files are moved at its commit, not at the job's), so after a crash or
    a lost executor the next run asks only for what is missing.  Should a prompt be in
    it twice, one answer counts.  Calls that failed for good are answers too.  Returns
    keys, raw, attempts, call_status, call_error, as ``llm_map``.

    What is missing is found on the keys of the prompts, which are written; prompts are
    sent to another task only where a bitmap says that they may occur again (or where the
    ledger holds some of them).  ``df`` is read up to three times."""
    spark = df.sparkSession
    schema = "prompt_key string, raw string, attempts int, call_status int, call_error string"
    prompts = df.withColumn("prompt_key", prompt_key(F.col(prompt_col), system))
    asked = write_scratch(prompts.select(*key_cols, "prompt_key"), "asked")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    known = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    missing = asked.groupBy("prompt_key").agg(F.count("*").alias("__n"))
    if known:
        answered = spark.read.schema(schema).parquet(ledger).select("prompt_key")
        missing = missing.join(answered, "prompt_key", "left_anti")
    missing = write_scratch(missing.select(F.xxhash64("prompt_key").alias("__h"), (F.col("__n") > 1).alias("__again")), "missing")
    if not missing.isEmpty():
        rows = prompts.select("prompt_key", prompt_col, F.xxhash64("prompt_key").alias("__h"))
        if known:
            rows = may_be_in(rows, "__h", bitmap_of(missing.select("__h"))).join(answered, "prompt_key", "left_anti")
        again = bitmap_of(missing.where("__again").select("__h"))
        rows = cannot_be_in(rows, "__h", again).unionByName(may_be_in(rows, "__h", again).dropDuplicates(["prompt_key"]))
        (llm_map(rows, prompt_col, client_factory, ["prompt_key"], system, sleep)
         .write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(ledger))
    elif not known:                                     # no prompts at all: the ledger is there, empty
        spark.createDataFrame([], schema).write.mode("append").parquet(ledger)
    # dealt by key before they are compared, so that they are sorted once
    answers = spark.read.schema(schema).parquet(ledger).repartition("prompt_key").dropDuplicates(["prompt_key"])
    return asked.join(answers, "prompt_key").select(*key_cols, "raw", "attempts", "call_status", "call_error")


def json_status(clean: Column) -> Column:
    """E4 strict guard: 'bad_json' unless the text is exactly one JSON value
    (no trailing text, no single quotes); 'ok' if it is an object whose
    ``text`` is a string; else 'no_text'.  As in Python's parser the values NaN and
    (-)Infinity are accepted; unlike there a repeated key is an error, as it is
    ambiguous which value was meant."""
    plain = F.regexp_replace(clean, F.lit(r"([:,\[]\s*)-?(?:NaN|Infinity)(?=\s*[,}\]])"), F.lit("$1null"))
    clean = F.when(clean.contains("NaN") | clean.contains("Infinity"), plain).otherwise(clean)     # few texts need it
    wrapped = F.try_parse_json(F.concat(F.lit("["), clean, F.lit("]")))
    as_value = F.try_parse_json(F.concat(F.lit('{"v":'), clean, F.lit("}")))
    n = F.json_array_length(F.concat(F.lit("["), clean, F.lit("]")))
    text_t = F.schema_of_variant(F.variant_get(wrapped, "$[0].text", "variant"))
    return (F.when(wrapped.isNull() | as_value.isNull() | (n != 1), F.lit("bad_json"))
            .when(text_t == "STRING", F.lit("ok")).otherwise(F.lit("no_text")))


def parse_responses(df: DataFrame, raw: str = "raw") -> DataFrame:
    """E3 + E4: clean, classify and parse; adds clean, status, text, entities."""
    df = df.withColumn("clean", pin(strip_fence(F.col(raw))))
    df = df.withColumn("status", pin(F.when(F.col(raw).isNull(), F.lit("no_response"))
                                     .otherwise(json_status(F.col("clean")))))
    parsed = F.from_json(F.col("clean"), RESPONSE_JSON)
    return (df.withColumn("text", F.when(F.col("status") == "ok", parsed["text"]))
            .withColumn("resp_entities", F.when(F.col("status") == "ok", parsed["entities"])))


def attach_spans(df: DataFrame, text: str, requested: str) -> DataFrame:
    """Spans of the *requested* entities (not the model's) in ``text``;
    a row with any unfound term is marked 'unmatched'."""
    df = df.withColumn("spans", pin(F.when(F.col(text).isNotNull(),
                                           find_spans_next(F.col(text), F.col(requested)))))
    return df.withColumn("final_status", pin(F.when(F.col("status") != "ok", F.col("status"))
                                             .when(has_unmatched(F.col("spans")), F.lit("unmatched"))
                                             .otherwise(F.lit("accepted"))))


def first_n_in_waves(rows: DataFrame, n: int, order: str, respond: Callable[[DataFrame], DataFrame], times: int = 5,
                     spare: float = 1.1) -> DataFrame:
    """E7 with its early stop: the first ``n`` accepted rows in attempt order, making no
    more attempts than it takes to find them (a wave's spare apart).

    ``rows`` are the attempts; ``respond`` makes them (a row with ``final_status`` for
    each).  The attempts, ``times * n`` at most, are numbered in a distributed sort.  A
    wave holds as many as the acceptance rate so far asks for, and ``spare`` times
    that; its rows are written before they are counted, so nothing is made twice.  The
    driver sees two counts a wave."""
    numbered = dense_index(attempts_for(rows, n, order, times), [order])
    total = numbered.count()
    made = accepted = 0
    answered: DataFrame | None = None
    while made < total and accepted < n:
        rate = (accepted + 1) / (made + 1)                   # nothing is known at first: every attempt
        wave = min(total - made, max(1, math.ceil(spare * (n - accepted) / rate)) if made else n)
        part = numbered.where((F.col("idx") >= made) & (F.col("idx") < made + wave)).drop("idx")
        part = write_scratch(respond(part), "wave")
        accepted += part.where(F.col("final_status") == "accepted").count()
        made += wave
        answered = part if answered is None else answered.unionByName(part)
    if answered is None:
        answered = respond(numbered.drop("idx"))
    return first_n_valid(answered, n, order)


def attempts_for(rows: DataFrame, n: int, order: str, times: int = 5) -> DataFrame:
    """The attempts made for ``n`` sentences, ``times`` n of them at most."""
    return rows.orderBy(order).limit(times * n)


def first_n_valid(df: DataFrame, n: int, order: str) -> DataFrame:
    """The first ``n`` accepted rows in attempt order (top-k, not a full sort)."""
    return df.where(F.col("final_status") == "accepted").orderBy(order).limit(n)


def require_nonempty(df: DataFrame, what: str = "valid sentences") -> DataFrame:
    """Fail when nothing valid was produced.

    The check is part of the plan: one row is left-joined with ``df`` (the first N
    rows, so one small group), and raises if it meets nothing.  Building the query
    runs nothing and the responses are made once."""
    one = df.sparkSession.range(1).select(F.lit(1).alias("__key"))
    met = one.join(df.withColumn("__key", F.lit(1)).withColumn("__row", F.lit(True)), "__key", "left")
    return met.where(F.coalesce("__row", F.raise_error(F.lit(f"no {what} produced")).cast("boolean"))).drop("__key", "__row")


def funnel(df: DataFrame) -> DataFrame:
    """Rows per final status."""
    return df.groupBy("final_status").agg(F.count("*").alias("n"))


def assemble_record(df: DataFrame, text: str = "text") -> DataFrame:
    """Canonical record (sentence, ner_labels)."""
    return df.withColumn("sentence", F.col(text)).withColumn("ner_labels", spans_to_labels(F.col("spans")))
