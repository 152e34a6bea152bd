"""Synthetic-corpus generation plan (C -> D -> E), bound to the given tables.

rows to generate: ``orders.o_orderkey``; medication lexicon: ``part.p_name``;
diagnosis lexicon: ``nation.n_name`` (source ``code_list``) or ``part.p_type`` (source
``fallback``); dose values: ``part`` sizes with a fraction; dose units:
``lower(part.p_type)``.  Shape: scan -> draws (Project) -> the lookups of all slots in one
join with the one lexicon table -> put together by row -> prompt (Project).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.functions.arrays import pin
from spanforge.functions.hashing import draw_index
from spanforge.operators import prompts, sampling
from spanforge.operators.spans import parse_tags, strip_tags
from spanforge.plans.bindings import SEED, asked_partitions
from spanforge.schemas import ORIGINAL_SENTENCES, RANDOM_SHAPE_POOL_SIZE, SHAPES
from spanforge.session import table
from spanforge.sources.lexicon_store import size_of, stored_lexicon

VALUE, UNIT = "Dosis-Wert", "Dosis-Einheit"
#: Which source a label's terms are drawn from
SOURCES = {"Medikation": "curated", "Diagnose": "code_list", VALUE: "code_list", UNIT: "code_list"}
_CODE = {"Medikation": 0, "Diagnose": 1, VALUE: 2, UNIT: 3}
#: places that the draws of a label are spread over at least in the lookup join
LOOKUP_SPREAD = 4096
_SALT = {"Medikation": "med", "Diagnose": "diag", VALUE: "val", UNIT: "unit"}


def lexicon(spark: SparkSession, d: str) -> DataFrame:
    """The lexicon table of the given tables, all sources and labels."""
    def terms() -> DataFrame:
        part, nation = table(spark, d, "part"), table(spark, d, "nation")

        def rows(source: str, label: str, term: Column, df: DataFrame, key: str, by_text: bool) -> DataFrame:
            text = term.alias("term")
            return df.select(F.lit(source).alias("source"), F.lit(label).alias("label"), text,
                             (term if by_text else F.lit("")).alias("o1"), F.col(key).cast("long").alias("o2"))
        value = sampling.float_text(F.col("p_size") + F.pmod("p_partkey", F.lit(4)) * 0.25)
        return (rows("curated", "Medikation", F.col("p_name"), part, "p_partkey", True)
                .union(rows("code_list", "Diagnose", F.col("n_name"), nation, "n_nationkey", True))
                .union(rows("fallback", "Diagnose", F.col("p_type"), part, "p_partkey", False))
                .union(rows("code_list", VALUE, value, part, "p_partkey", False))
                .union(rows("code_list", UNIT, F.lower("p_type"), part, "p_partkey", False)))
    return stored_lexicon(spark, [f"{d}/part.parquet", f"{d}/nation.parquet"], terms, ["o1", "o2"])


def gen_rows(spark: SparkSession, d: str) -> DataFrame:
    return asked_partitions(spark, table(spark, d, "orders").select(F.col("o_orderkey").alias("row_id")))


def pooled_shape(seed, row: Column) -> Column:
    """A pool of ``RANDOM_SHAPE_POOL_SIZE`` random shapes, each drawn by the keyed
    hash of its number; a row takes one of them."""
    return sampling.random_shape(seed, draw_index(RANDOM_SHAPE_POOL_SIZE, seed, row, "pool"))


def entity_rows(spark: SparkSession, d: str, rows: DataFrame | None = None,
                shape: Callable[[object, Column], Column] = sampling.shape_of, slots: int = max(map(len, SHAPES)),
                sources: dict[str, str] = SOURCES) -> DataFrame:
    """One row per generation attempt with its ordered entity list.

    ``rows``: the attempts (default: all); ``shape``: the label template of a row (C2,
    or C3's pool), of ``slots`` labels at most; ``sources``: C9's switch.  What a row asks
    of the lexicon table are small rows of their own, (label code, index): one for each
    slot, for a dose one for its value and one for its unit.  They meet the lexicon in one
    merge join, however large it is, and are put together by row, at most two a slot.  A
    short lexicon is repeated (``LOOKUP_SPREAD``), so that no term is a hot key."""
    lex = lexicon(spark, d)
    n = {label: size_of(lex, source, label) for label, source in sources.items()}
    chosen = F.lit(False)
    for label, source in sources.items():
        chosen = chosen | ((F.col("label") == label) & (F.col("source") == source))
    code = F.lit(None).cast("int")
    for label, number in _CODE.items():
        code = F.when(F.col("label") == label, number).otherwise(code)
    r = F.col("row_id")

    def spread(size: Column) -> Column:
        return F.greatest(F.ceil(F.lit(LOOKUP_SPREAD) / size).cast("int"), F.lit(1))

    def asked(slot: int, part: int, label: str) -> Column:
        idx = draw_index(n[label], SEED, r, F.lit(slot), _SALT[label])
        salt = F.pmod(F.xxhash64(r, F.lit(slot)), spread(n[label])).cast("int")
        return F.struct(F.lit(2 * slot + part).alias("__at"), F.lit(_CODE[label]).alias("__code"), idx.alias("__idx"),
                        salt.alias("__salt"))

    terms = lex.where(chosen).select(code.alias("__code"), F.col("idx").alias("__idx"), F.col("term").alias("__term"),
                                     F.explode(F.sequence(F.lit(0), spread(F.col("n")) - 1)).alias("__salt"))
    # all that is drawn follows from the row's id: rows that share one are made once
    made_once = (gen_rows(spark, d) if rows is None else rows).groupBy("row_id").agg(F.count("*").cast("int").alias("__copies"))
    labels = [F.get("__shape", F.lit(slot)) for slot in range(slots)]
    lookups = []
    for slot, label in enumerate(labels):
        value = F.when(label == "Dosis", asked(slot, 0, VALUE))
        for name in ("Medikation", "Diagnose"):
            value = value.when(label == name, asked(slot, 0, name))
        lookups += [value, F.when(label == "Dosis", asked(slot, 1, UNIT))]
    rows_asked = (made_once.select("row_id", "__copies", pin(shape(SEED, r)).alias("__shape"))
                  .select("row_id", "__copies", F.inline_outer(F.array_compact(F.array(*lookups)))))
    # merged, not broadcast: by its file statistics a well compressed lexicon looks small
    found = rows_asked.join(terms.hint("merge"), ["__code", "__idx", "__salt"], "left")
    entries = F.collect_list(F.when(F.col("__at").isNotNull(), F.struct("__at", "__term")))
    df = (found.groupBy("row_id", "__copies").agg(F.map_from_entries(entries).alias("__found"))
          .select("row_id", "__found", F.explode(F.array_repeat(F.lit(1), F.col("__copies"))).alias("__copy"))
          .select("row_id", "__found", pin(shape(SEED, r)).alias("__shape")))
    made = []
    for slot, label in enumerate(labels):
        term, unit = (F.element_at("__found", F.lit(2 * slot + part)) for part in (0, 1))
        text = F.when(label == "Dosis", sampling.dosage_text(term, unit, SEED, r, F.lit(slot))).otherwise(term)
        made.append(F.when(label.isNotNull(), F.struct(text.alias("text"), label.alias("label"))))
    return df.select("row_id", pin(F.array_compact(F.array(*made))).alias("entities"))


def slot_rows(spark: SparkSession, d: str, **how) -> DataFrame:
    """C6 as rows: (row_id, slot, label, text)."""
    e = entity_rows(spark, d, **how)
    return (e.select("row_id", F.posexplode_outer("entities").alias("slot", "e")).where(F.col("e").isNotNull())
            .select("row_id", "slot", "e.label", "e.text"))


def example_pool(spark: SparkSession) -> list[str]:
    """The few-shot pool: the fixed tagged sentences parsed (F4/F5) and
    rendered as JSON examples — twelve rows, collected as a constant."""
    df = spark.createDataFrame([(i, s) for i, s in enumerate(ORIGINAL_SENTENCES)], "i int, tagged string")
    js = df.select("i", prompts.example_json(strip_tags(F.col("tagged")), parse_tags(F.col("tagged"))).alias("j"))
    return [r["j"] for r in js.orderBy("i").collect()]


def prompt_variant_rows(spark: SparkSession, d: str, variants: tuple[str, ...], k: int = 2) -> DataFrame:
    """(row_id, variant, prompt); entities, examples and draws are made once."""
    rows = prompt_parts(spark, d, k).select("row_id", F.inline_outer(F.array(*[
        F.struct(F.lit(v).alias("variant"),
                 prompts.build_prompt(F.col("task"), F.col("style"), F.col("context"), F.col("examples"), v).alias("prompt"))
        for v in variants])))
    return rows.where(F.col("variant").isNotNull())


def prompt_parts(spark: SparkSession, d: str, k: int = 2) -> DataFrame:
    """D5 parts per attempt: entities, task, style, context, k examples."""
    ents = entity_rows(spark, d)
    pool = F.array(*[F.lit(j) for j in example_pool(spark)])
    picks = sampling.sample_without_replacement(pool, k, SEED, F.col("row_id"))
    examples = prompts.examples_block(F.transform(picks, lambda p: p["e"]))
    style, ctx = sampling.style_context(SEED, F.col("row_id"))
    return ents.select("row_id", "entities", prompts.task_block(F.col("entities")).alias("task"),
                       style.alias("style"), ctx.alias("context"), examples.alias("examples"))


def prompt_rows(spark: SparkSession, d: str, variant: str = "script", k: int = 2) -> DataFrame:
    """Full prompt per attempt."""
    prompt = prompts.build_prompt(F.col("task"), F.col("style"), F.col("context"), F.col("examples"), variant)
    return prompt_parts(spark, d, k).select("row_id", "entities", prompt.alias("prompt"))


# --- responses table (what a model returned), derived from the attempts -------

def response_sentence(entities) -> F.Column:
    return F.concat(F.lit("Patient "), F.array_join(F.transform(entities, lambda e: e["text"]), " und "), F.lit("."))


def raw_responses(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    """responses(row_id, entities, raw): a JSON answer per attempt; by keyed
    hash some are fenced, truncated, lack ``text``, miss a term, or carry
    blank padding."""
    e = entity_rows(spark, d, rows=rows)
    r = F.col("row_id")
    v = draw_index(10, SEED, r, "resp")
    first = F.get(F.col("entities"), 0)["text"]
    sent = response_sentence(F.col("entities"))
    sent = F.when(v == 3, F.replace(sent, first, F.lit("etwas"))).otherwise(sent)
    ent_json = F.array_join(F.transform("entities", lambda x: F.concat(
        F.lit('{"text": '), prompts.json_str(x["text"]), F.lit(', "label": '), prompts.json_str(x["label"]),
        F.lit("}"))), ", ")
    js = F.concat(F.lit('{"text": '), prompts.json_str(sent), F.lit(', "entities": ['), ent_json, F.lit("]}"))
    raw = (F.when(v == 0, F.concat(F.lit("```json\n"), js, F.lit("\n```")))
           .when(v == 1, F.substring(js, 1, F.length(js) - 5))
           .when(v == 2, F.lit('{"entities": []}'))
           .when(v == 4, F.concat(F.lit("  "), js, F.lit("\n")))
           .otherwise(js))
    return e.select("row_id", "entities", pin(raw).alias("raw"), pin(sent).alias("plain"))
