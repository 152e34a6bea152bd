"""Registered queries: draws (C), prompts and chats (D), responses (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.functions.hashing import draw_index
from spanforge.operators import prompts, responses, sampling
from spanforge.operators.lexicon import lexicon_by_source as choose_source
from spanforge.plans import generation as G
from spanforge.plans import oracle as O
from spanforge.plans.bindings import SEED
from spanforge.plans.queries_corpus import joined
from spanforge.plans.registry import query
from spanforge.schemas import CONTEXTS, FIXED_DOSE_UNITS, FIXED_DOSE_VALUES, SHAPES, SHAPES_NOTEBOOK, STYLES, SYSTEM_PROMPT
from spanforge.session import table, write_scratch
from spanforge.sources.lexicon_store import size_of

S = str(SEED)


def _terms(lex, source, label):
    return choose_source(lex, source).where(F.col("label") == label)


def _rows(spark, d):
    return G.gen_rows(spark, d)


# --- C: draws ------------------------------------------------------------------

@query("choice_uniform", lambda: O.with_(*O.gen_lexica()) +
       f"SELECT o_orderkey AS row_id, m.idx, m.term FROM orders CROSS JOIN lex_n "
       f"JOIN meds m ON m.idx = {O.draw('lex_n.nm', S, 'o_orderkey', '0', chr(39) + 'med' + chr(39))}")
def choice_uniform(spark, d):
    """Uniform, seeded choice from a lexicon (duplicates weight the draw)."""
    lex = G.lexicon(spark, d)
    n = size_of(lex, "curated", "Medikation")
    r = _rows(spark, d).withColumn("idx", draw_index(n, SEED, F.col("row_id"), 0, "med"))
    return sampling.draw_from(r, _terms(lex, "curated", "Medikation"), F.col("idx"), "term").select("row_id", "idx", "term")


@query("shape_choice", lambda: O.with_(O.shapes_cte(SHAPES)) +
       f"SELECT o_orderkey AS row_id, shape_id, array_to_string(shape, ',') AS shape FROM orders "
       f"JOIN shapes ON shape_id = {O.draw('7', S, 'o_orderkey', chr(39) + 'shape' + chr(39))}")
def shape_choice(spark, d):
    """One ordered label template per sentence."""
    r = _rows(spark, d)
    sid = draw_index(len(SHAPES), SEED, F.col("row_id"), "shape")
    return r.select("row_id", sid.alias("shape_id"),
                    F.array_join(sampling.shape_of(SEED, F.col("row_id")), ",").alias("shape"))


@query("shape_choice_notebook", lambda: O.with_(O.shapes_cte(SHAPES_NOTEBOOK)) +
       f"SELECT o_orderkey AS row_id, array_to_string(shape, ',') AS shape FROM orders "
       f"JOIN shapes ON shape_id = {O.draw('5', S, 'o_orderkey', chr(39) + 'shape' + chr(39))}")
def shape_choice_notebook(spark, d):
    """The variant with five templates."""
    return _rows(spark, d).select("row_id", F.array_join(sampling.shape_of(SEED, F.col("row_id"), SHAPES_NOTEBOOK), ",")
                                  .alias("shape"))


def _random_shape_sql():
    return (O.with_(*O.random_shape_ctes("SELECT o_orderkey AS row_id FROM orders"))
            + "SELECT row_id, string_agg(label, ',' ORDER BY slot) AS shape FROM rs GROUP BY row_id")


@query("random_shape", _random_shape_sql)
def random_shape(spark, d):
    """Random template: n_med, n_diag in [0,1,1,2], n_dose in [0,1] only
    with a medication, never empty, order shuffled."""
    r = _rows(spark, d)
    return r.select("row_id", F.array_join(sampling.random_shape(SEED, F.col("row_id")), ",").alias("shape"))


@query("make_dosage", lambda: O.with_(*O.gen_lexica()) +
       f"SELECT o_orderkey AS row_id, replace(v.term || CASE WHEN {O.unit(S, 'o_orderkey', '0', chr(39) + 'space' + chr(39))}"
       f" < 0.7 THEN '' ELSE ' ' END || u.term, '.', ',') AS dosage FROM orders CROSS JOIN lex_n "
       f"JOIN vals v ON v.idx = {O.draw('lex_n.nv', S, 'o_orderkey', '0', chr(39) + 'val' + chr(39))} "
       f"JOIN units u ON u.idx = {O.draw('lex_n.nu', S, 'o_orderkey', '0', chr(39) + 'unit' + chr(39))}")
def make_dosage(spark, d):
    """C4: value and unit drawn independently, 70 % without a space, '.' -> ','."""
    lex, r = G.lexicon(spark, d), _rows(spark, d)
    for label, salt, out in ((G.VALUE, "val", "v"), (G.UNIT, "unit", "u")):
        n = size_of(lex, "code_list", label)
        r = sampling.draw_from(r, _terms(lex, "code_list", label), draw_index(n, SEED, F.col("row_id"), 0, salt), out)
    return r.select("row_id", sampling.dosage_text(F.col("v"), F.col("u"), SEED, F.col("row_id"), 0).alias("dosage"))


@query("make_dosage_fixed", lambda:
       f"SELECT o_orderkey AS row_id, replace({O._lit_list(FIXED_DOSE_VALUES)}[{O.draw('11', S, 'o_orderkey', chr(39) + 'fv' + chr(39))} + 1]"
       f" || CASE WHEN {O.unit(S, 'o_orderkey', '0', chr(39) + 'space' + chr(39))} < 0.7 THEN '' ELSE ' ' END || "
       f"{O._lit_list(FIXED_DOSE_UNITS)}[{O.draw('5', S, 'o_orderkey', chr(39) + 'fu' + chr(39))} + 1], '.', ',') AS dosage "
       "FROM orders")
def make_dosage_fixed(spark, d):
    """Dosage from the fixed value list (ints print without ',0')."""
    r = _rows(spark, d)
    v = sampling.choose(FIXED_DOSE_VALUES, SEED, F.col("row_id"), "fv")
    u = sampling.choose(FIXED_DOSE_UNITS, SEED, F.col("row_id"), "fu")
    return r.select("row_id", sampling.dosage_text(v, u, SEED, F.col("row_id"), 0).alias("dosage"))


@query("sample_entities", lambda: O.with_(*O.gen_slots()) + "SELECT row_id, slot, label, text FROM slot_text")
def sample_entities(spark, d):
    """Fill each row's template with drawn terms (with replacement)."""
    return G.slot_rows(spark, d)


@query("sample_entities_pool", lambda: O.with_(*O.gen_slots(O.pooled_slots())) +
       "SELECT row_id, slot, label, text FROM slot_text")
def sample_entities_pool(spark, d):
    """C3 -> C6: each row takes one of the pool's 100 random shapes and fills it."""
    return G.slot_rows(spark, d, shape=G.pooled_shape, slots=5)


@query("sample_entities_source", lambda: O.with_(*O.gen_slots(diags=O.FALLBACK_DIAGS)) +
       "SELECT row_id, slot, label, text FROM slot_text")
def sample_entities_source(spark, d):
    """C9 -> C6: diagnoses drawn from another source of the lexicon table."""
    return G.slot_rows(spark, d, sources={**G.SOURCES, "Diagnose": "fallback"})


@query("lexicon_table", lambda: """SELECT 'curated' AS source, 'Medikation' AS label, count(*)::INTEGER AS n,
  count(*)::BIGINT AS n_rows, 0 AS first_idx, (count(*) - 1)::INTEGER AS last_idx, count(DISTINCT p_name)::BIGINT AS n_terms FROM part
UNION ALL SELECT 'code_list', 'Diagnose', count(*)::INTEGER, count(*)::BIGINT, 0, (count(*) - 1)::INTEGER, count(DISTINCT n_name)::BIGINT FROM nation
UNION ALL SELECT 'fallback', 'Diagnose', count(*)::INTEGER, count(*)::BIGINT, 0, (count(*) - 1)::INTEGER, count(DISTINCT p_type)::BIGINT FROM part
UNION ALL SELECT 'code_list', 'Dosis-Wert', count(*)::INTEGER, count(*)::BIGINT, 0, (count(*) - 1)::INTEGER,
  count(DISTINCT p_size + (p_partkey % 4) * 0.25)::BIGINT FROM part
UNION ALL SELECT 'code_list', 'Dosis-Einheit', count(*)::INTEGER, count(*)::BIGINT, 0, (count(*) - 1)::INTEGER, count(DISTINCT lower(p_type))::BIGINT FROM part""")
def lexicon_table(spark, d):
    """The written lexicon table, its sources and labels with their sizes."""
    return G.lexicon(spark, d).groupBy("source", "label").agg(
        F.max("n").alias("n"), F.countDistinct("idx").alias("n_rows"), F.min("idx").alias("first_idx"),
        F.max("idx").alias("last_idx"), F.countDistinct("term").alias("n_terms"))


@query("sample_without_replacement", lambda: O.with_(*O.prompt_ctes()[:-3]) +
       "SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY k)::INTEGER - 1 AS pick, js AS example "
       "FROM picks")
def sample_without_replacement(spark, d):
    """k=2 distinct few-shot examples per row, keyed-hash order."""
    pool = F.array(*[F.lit(j) for j in G.example_pool(spark)])
    r = _rows(spark, d).withColumn("p", sampling.sample_without_replacement(pool, 2, SEED, F.col("row_id")))
    return r.select("row_id", F.posexplode_outer("p").alias("pick", "x")).where(F.col("x").isNotNull()).select(
        "row_id", F.col("pick").cast("int").alias("pick"), F.col("x.e").alias("example"))


@query("style_context", lambda:
       f"SELECT o_orderkey AS row_id, {O._lit_list(STYLES)}[{O.draw('5', S, 'o_orderkey', chr(39) + 'style' + chr(39))} + 1]"
       f" AS style, {O._lit_list(CONTEXTS)}[{O.draw('6', S, 'o_orderkey', chr(39) + 'ctx' + chr(39))} + 1] AS context "
       "FROM orders")
def style_context(spark, d):
    """Style (5) and context (6) draws."""
    st, cx = sampling.style_context(SEED, F.col("row_id"))
    return _rows(spark, d).select("row_id", st.alias("style"), cx.alias("context"))


@query("lexicon_by_source", lambda: "SELECT term FROM (SELECT p_name AS term, 'curated' AS source FROM part "
       "UNION ALL SELECT n_name, 'code_list' FROM nation UNION ALL SELECT p_type, 'fallback' FROM part) "
       "WHERE source = 'code_list'")
def lexicon_by_source(spark, d):
    """A lexicon table with a source column; pick one source."""
    p = table(spark, d, "part")
    lex = (p.select(F.col("p_name").alias("term"), F.lit("curated").alias("source"))
           .unionByName(table(spark, d, "nation").select(F.col("n_name").alias("term"), F.lit("code_list").alias("source")))
           .unionByName(p.select(F.col("p_type").alias("term"), F.lit("fallback").alias("source"))))
    return choose_source(lex, "code_list").select("term")


# --- D: prompts and chats --------------------------------------------------------

@query("prompt_task", lambda: O.with_(*O.gen_slots(),
                                      "task AS (SELECT row_id, 'Begriffe:' || chr(10) || string_agg('- ' || label || "
                                      "': ' || text, chr(10) ORDER BY slot) AS task FROM slot_text GROUP BY row_id)")
       + "SELECT row_id, task FROM task")
def prompt_task(spark, d):
    """Task block with one ``- label: text`` line per entity."""
    e = G.entity_rows(spark, d)
    return e.select("row_id", prompts.task_block(F.col("entities")).alias("task"))


@query("prompt_examples", lambda: O.with_(*O.prompt_ctes()[:-2]) + "SELECT row_id, ex AS examples FROM examples")
def prompt_examples(spark, d):
    """D3: few-shot block — two pool examples as JSON with Python separators."""
    pool = F.array(*[F.lit(j) for j in G.example_pool(spark)])
    picks = sampling.sample_without_replacement(pool, 2, SEED, F.col("row_id"))
    return _rows(spark, d).select("row_id", prompts.examples_block(F.transform(picks, lambda p: p["e"])).alias("examples"))


def _prompt_sql(variant):
    """The variants spelled out in SQL (not from ``prompts.VARIANTS``)."""
    from spanforge.schemas import FORMAT_LINES, SYSTEM_PROMPT_SENTENCE
    gap = "chr(10) || chr(10)"
    said = lambda t: O.q("System: " + t + "\n\nUser:\n")
    labels = O.q("Format:\n" + FORMAT_LINES["label_list"])
    return {
        "script": f"task || {gap} || sc || {gap} || fmt || {gap} || ex || chr(10)",
        "system": f"{said(SYSTEM_PROMPT)} || task || {gap} || sc || {gap} || fmt || {gap} || ex || chr(10)",
        "no_format": f"{said(SYSTEM_PROMPT_SENTENCE)} || task || {gap} || sc || {gap} || ex || chr(10)",
        "system_no_style": f"{said(SYSTEM_PROMPT)} || task || {gap} || {labels} || {gap} || ex || chr(10)",
        "bare": f"task || {gap} || {labels} || {gap} || ex || chr(10)",
    }[variant]


@query("build_prompt", lambda: O.with_(*O.prompt_ctes()) + f"SELECT row_id, {_prompt_sql('script')} AS prompt "
       "FROM prompt_parts")
def build_prompt(spark, d):
    """Full user prompt (task, style/context, format, examples)."""
    return G.prompt_rows(spark, d).select("row_id", "prompt")


_VARIANTS = ("script", "system", "no_format", "system_no_style", "bare")


@query("build_prompt_variants", lambda: O.with_(*O.prompt_ctes()) +
       " UNION ALL ".join(f"SELECT row_id, '{v}' AS variant, {_prompt_sql(v)} AS prompt FROM prompt_parts"
                          for v in _VARIANTS))
def build_prompt_variants(spark, d):
    """D6 (+D2, D4): one row per variant; the parts are computed once and exploded."""
    return G.prompt_variant_rows(spark, d, _VARIANTS)


def _fixed_prompt_sql():
    from spanforge.schemas import FIXED_EXAMPLES, FORMAT_LINES, SYSTEM_PROMPT_EARLY
    head = O.q("System: " + SYSTEM_PROMPT_EARLY + "\n\nUser:\n")
    tail = O.q("\n\nFormat:\n" + FORMAT_LINES["notebook"] + "\n\nBeispiel Sätze:\n"
               + "".join(e + "\n" for e in FIXED_EXAMPLES))
    return (O.with_(*O.gen_slots(), "task AS (SELECT row_id, 'Begriffe:' || chr(10) || string_agg('- ' || label || "
                    "': ' || text, chr(10) ORDER BY slot) AS task FROM slot_text GROUP BY row_id)")
            + f"SELECT row_id, {head} || task || {tail} AS prompt FROM task")


@query("prompt_fixed_examples", _fixed_prompt_sql)
def prompt_fixed_examples(spark, d):
    """Prompt with the fixed two-example block (early notebook wording)."""
    e = G.entity_rows(spark, d)
    return e.select("row_id", prompts.build_prompt_fixed_examples(prompts.task_block(F.col("entities"))).alias("prompt"))


@query("chat_messages", lambda: "SELECT conv_id, turn, 2 AS n_messages, 'system,user' AS roles, "
       f"{O.q(SYSTEM_PROMPT)} AS system_content, text AS user_content FROM conversations WHERE role = 'user'")
def chat_messages(spark, d):
    """[system, user] messages for every user turn."""
    c = table(spark, d, "conversations").where(F.col("role") == "user")
    m = prompts.chat_messages(F.col("text"))
    return c.select("conv_id", "turn", F.size(m).alias("n_messages"),
                    F.array_join(F.transform(m, lambda x: x["role"]), ",").alias("roles"),
                    F.get(m, 0)["content"].alias("system_content"), F.get(m, 1)["content"].alias("user_content"))


@query("chat_fold_system", lambda: f"SELECT conv_id, turn, {O.q(SYSTEM_PROMPT + chr(10) + chr(10))} || text AS content "
       "FROM conversations WHERE role = 'user'")
def chat_fold_system(spark, d):
    """The system text folded into the user turn."""
    c = table(spark, d, "conversations").where(F.col("role") == "user")
    m = prompts.fold_system(F.col("text"))
    return c.select("conv_id", "turn", F.get(m, 0)["content"].alias("content"))


# --- E: responses -----------------------------------------------------------------

def _parsed(spark, d, rows=None):
    r = G.raw_responses(spark, d, rows)
    return responses.parse_responses(r, "raw")


def _final(spark, d, rows=None):
    return responses.attach_spans(_parsed(spark, d, rows), "text", "entities")


@query("strip_code_fence", lambda: O.with_(*O.responses_ctes()[:-4]) + "SELECT row_id, clean FROM parsed")
def strip_code_fence(spark, d):
    """Trim, drop a leading ```lang fence and a trailing fence."""
    return _parsed(spark, d).select("row_id", "clean")


@query("parse_response", lambda: O.with_(*O.responses_ctes()[:-4]) +
       "SELECT row_id, status, CASE WHEN status = 'ok' THEN json_extract_string(clean, '$.text') END AS text FROM parsed")
def parse_response(spark, d):
    """Strict JSON acceptance -> ok / bad_json / no_text, and the text."""
    return _parsed(spark, d).select("row_id", "status", "text")


@query("plain_response_spans", lambda: O.with_(*O.responses_ctes()[:-6], "gen_req AS (SELECT s.row_id AS sent_id, "
                                               "'ok' AS status, r.plain AS sentence, s.slot AS pos, s.text, s.label "
                                               "FROM slot_text s JOIN resp1 r USING (row_id))",
                                               *O.responses_ctes()[-3:-1]) +
       "SELECT sent_id AS row_id, pos, label, start, (start + tlen)::INTEGER AS stop FROM gen_f2")
def plain_response_spans(spark, d):
    """E5: text mode — the response is the sentence itself; spans of the
    requested terms are found directly (no JSON step)."""
    r = G.raw_responses(spark, d)
    from spanforge.operators.spans import find_spans_next
    s = r.select("row_id", F.inline_outer(find_spans_next(F.col("plain"), F.col("entities"))))
    return s.where(F.col("ord").isNotNull()).select("row_id", F.col("ord").alias("pos"), "label", "start", "stop")


def _first_n_sql():
    return (O.with_(*O.responses_ctes()) +
            "SELECT f.row_id, json_extract_string(p.clean, '$.text') AS sentence FROM final f JOIN parsed p USING (row_id) "
            "WHERE f.final_status = 'accepted' AND f.row_id IN (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 250) "
            "ORDER BY f.row_id LIMIT 50")


@query("first_n_valid", _first_n_sql)
def first_n_valid(spark, d):
    """E7 (+E8): first 50 accepted sentences of at most 250 attempts, in attempt order;
    fails if none."""
    attempts = responses.attempts_for(G.gen_rows(spark, d), 50, "row_id")
    f = responses.first_n_valid(_final(spark, d, attempts), 50, "row_id").select("row_id", F.col("text").alias("sentence"))
    return responses.require_nonempty(f)


@query("first_n_waves", _first_n_sql)
def first_n_waves(spark, d):
    """E7 with its early stop: attempts are made in waves until 50 are accepted."""
    def respond(attempts):
        return _final(spark, d, attempts).select("row_id", "text", "final_status")
    f = responses.first_n_in_waves(G.gen_rows(spark, d), 50, "row_id", respond)
    return responses.require_nonempty(f.select("row_id", F.col("text").alias("sentence")))


@query("generation_funnel", lambda: O.with_(*O.responses_ctes()) +
       "SELECT final_status, count(*)::BIGINT AS n FROM final GROUP BY final_status")
def generation_funnel(spark, d):
    """Attempts per outcome (bad_json, no_text, unmatched, accepted)."""
    return responses.funnel(_final(spark, d))


@query("assemble_record", lambda: O.with_(*O.responses_ctes()) +
       ", acc AS (SELECT row_id FROM final WHERE final_status = 'accepted') "
       f"SELECT f.sent_id AS row_id, any_value(f.sentence) AS sentence, "
       f"{O.joined(O.CLASS_ID, 'f.start, f.pos')} AS ner_class, {O.joined('f.start', 'f.start, f.pos')} AS start, "
       f"{O.joined('f.start + f.tlen', 'f.start, f.pos')} AS stop FROM gen_f2 f JOIN acc a ON a.row_id = f.sent_id "
       "GROUP BY f.sent_id")
def assemble_record(spark, d):
    """Accepted rows as canonical records (sentence, ner_labels)."""
    f = responses.assemble_record(_final(spark, d).where(F.col("final_status") == "accepted"))
    return f.select("row_id", "sentence", joined(F.col("ner_labels.ner_class")).alias("ner_class"),
                    joined(F.col("ner_labels.start")).alias("start"), joined(F.col("ner_labels.stop")).alias("stop"))


def stub_client():
    """A stateless stand-in for a model client: answers with a JSON sentence built from
    the prompt's ``Begriffe`` block; prompts whose md5 is divisible by 7 fail with a
    retryable 503 on the first attempt, those divisible by 11 with a final 400."""
    import hashlib
    import json as _json

    def call(prompt: str, system: str, attempt: int) -> str:
        h = int(hashlib.md5(prompt.encode()).hexdigest()[:8], 16)
        if not system:
            raise responses.CallError(400, "no system instruction")
        if h % 11 == 0:
            raise responses.CallError(400)
        if h % 7 == 0 and attempt == 1:
            raise responses.CallError(503)
        lines = prompt.split("\n\n")[0].split("\n")[1:]
        ents = [dict(zip(("label", "text"), ln[2:].split(": ", 1))) for ln in lines if ln.startswith("- ")]
        sent = "Patient " + " und ".join(e["text"] for e in ents) + "."
        return _json.dumps({"text": sent, "entities": ents}, ensure_ascii=False)

    return call


def _llm_map_sql():
    return (O.with_(*O.prompt_ctes(), f"""calls AS (
  SELECT row_id, {_prompt_sql('script')} AS prompt FROM prompt_parts),
hashed AS (
  SELECT row_id, ('0x' || substr(md5(prompt), 1, 8))::BIGINT AS h FROM calls),
sent AS (
  SELECT row_id, 'Patient ' || string_agg(text, ' und ' ORDER BY slot) || '.' AS sentence FROM slot_text GROUP BY row_id)""")
       + "SELECT row_id, CASE WHEN h % 11 <> 0 AND h % 7 = 0 THEN 2 ELSE 1 END::INTEGER AS attempts, "
       "CASE WHEN h % 11 = 0 THEN 400 ELSE 200 END::INTEGER AS call_status, "
       "CASE WHEN h % 11 = 0 THEN 'status 400' END AS call_error, "
       "CASE WHEN h % 11 = 0 THEN 'no_response' ELSE 'ok' END AS status, "
       "CASE WHEN h % 11 <> 0 THEN sentence END AS text FROM hashed JOIN sent USING (row_id)")


@query("llm_map", _llm_map_sql)
def llm_map(spark, d):
    """E1 (+E2, E9): bulk model call with the system instruction, a client per task and
    retries; the call's code and error stay beside the parse status.  A deterministic
    client answers here, without sleeping."""
    p = G.prompt_rows(spark, d)
    r = responses.llm_map(p, "prompt", stub_client, ["row_id"], system=SYSTEM_PROMPT, sleep=lambda s: None)
    return responses.parse_responses(r, "raw").select("row_id", "attempts", "call_status", "call_error", "status", "text")


@query("llm_map_once", _llm_map_sql)
def llm_map_once(spark, d):
    """E1/E2 over a ledger of answered prompts: a second run finds all answers in it and
    calls nobody (its client would fail)."""
    from spanforge.sources.sinks import scratch_path

    def nobody():
        raise RuntimeError("every prompt is answered")

    # both runs read the same stored prompts, mostly the same words: they pack well
    p = write_scratch(G.prompt_rows(spark, d).select("row_id", "prompt"), "prompts", "zstd")
    ledger = scratch_path(spark, "ledger")
    responses.llm_map_once(p, "prompt", stub_client, ["row_id"], SYSTEM_PROMPT, ledger, sleep=lambda s: None)
    r = responses.llm_map_once(p, "prompt", nobody, ["row_id"], SYSTEM_PROMPT, ledger)
    return responses.parse_responses(r, "raw").select("row_id", "attempts", "call_status", "call_error", "status", "text")
