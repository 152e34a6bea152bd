"""DuckDB SQL oracles: an independent, set-based formulation of each query.

The Spark side works on per-sentence arrays; the oracle explodes to rows and
uses window functions and joins, so agreement is a real cross-check.  Shared
inputs (sentences, tokens, draws) are rebuilt here as CTEs from the same
tables with the same hash keys.
"""

from __future__ import annotations

from spanforge.functions.text import TOKEN_PATTERN
from spanforge.plans.bindings import FIXED_PHRASES, LINE_KEY_FACTOR, SEED

BLANKS = "(chr(9), chr(10), chr(11), chr(12), chr(13), ' ')"


def u32(*parts: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT)"


def draw(n: str, *parts: str) -> str:
    return f"(({u32(*parts)} % ({n}))::INTEGER)"


def unit(*parts: str) -> str:
    return f"({u32(*parts)} / 4294967296.0)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SENTENCES = f"""sentences AS (
  SELECT doc_id, line_no, doc_id * {LINE_KEY_FACTOR} + line_no AS sent_id, sentence FROM (
    SELECT doc_id, generate_subscripts(parts, 1) - 1 AS line_no, unnest(parts) AS sentence
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
  WHERE sentence <> '')"""

PIECES = f"""pieces AS (
  SELECT sent_id, k, piece,
         sum(length(piece)) OVER (PARTITION BY sent_id ORDER BY k) AS stop,
         coalesce(substr(lead(piece) OVER (PARTITION BY sent_id ORDER BY k), 1, 1) IN {BLANKS}, false) AS ws
  FROM (SELECT sent_id, generate_subscripts(pcs, 1) - 1 AS k, unnest(pcs) AS piece
        FROM (SELECT sent_id, regexp_extract_all(sentence, {q(TOKEN_PATTERN)}) AS pcs FROM sentences)))"""

TOKENS = f"""tokens AS (
  SELECT sent_id, (row_number() OVER (PARTITION BY sent_id ORDER BY k) - 1)::INTEGER AS i,
         piece AS token, (stop - length(piece))::INTEGER AS start, stop::INTEGER AS stop, ws
  FROM pieces WHERE substr(piece, 1, 1) NOT IN {BLANKS})"""


def phrase_keys_cte() -> str:
    vals = ", ".join(f"({q(p)}, {q(l)})" for p, l in FIXED_PHRASES)
    return f"""phrases AS (
  SELECT DISTINCT phrase, label FROM (
    SELECT * FROM (VALUES {vals}) v(phrase, label)
    UNION ALL SELECT p_name, 'Medikation' FROM part
    UNION ALL SELECT p_type, 'Dosis' FROM part
    UNION ALL SELECT n_name, 'Diagnose' FROM nation) WHERE phrase IS NOT NULL),
phrase_keys AS (
  SELECT DISTINCT array_to_string(t, ' ') AS key, len(t) AS n_tokens, label FROM (
    SELECT label, list_filter(regexp_extract_all(phrase, {q(TOKEN_PATTERN)}),
                              lambda x: substr(x, 1, 1) NOT IN {BLANKS}) AS t FROM phrases)
  WHERE len(t) > 0)"""


def grams_cte(max_len: int = 4) -> str:
    parts = []
    for L in range(1, max_len + 1):
        key = " || ' ' || ".join(["token"] + [f"lead(token, {k}) OVER w" for k in range(1, L)])
        stop = "stop" if L == 1 else f"lead(stop, {L - 1}) OVER w"
        parts.append(f"SELECT sent_id, i AS first_tok, i + {L} AS end_tok, start, {stop} AS stop, "
                     f"{key} AS key FROM tokens WINDOW w AS (PARTITION BY sent_id ORDER BY i)")
    return "grams AS (SELECT * FROM (" + "\n UNION ALL ".join(parts) + ") WHERE key IS NOT NULL)"


MATCHES = """matches AS (
  SELECT g.sent_id, g.first_tok::INTEGER AS first_tok, g.end_tok::INTEGER AS end_tok,
         g.start::INTEGER AS start, g.stop::INTEGER AS stop, p.label, g.key
  FROM grams g JOIN phrase_keys p ON g.key = p.key)"""

# greedy de-overlap: longest first, then earliest start, then label
FILTERED = """filtered AS (
  SELECT sent_id, unnest(list_sort(list_reduce(
      list(struct_pack(first_tok := first_tok, end_tok := end_tok, start := start, stop := stop, label := label)
           ORDER BY end_tok - first_tok DESC, first_tok, label),
      lambda acc, s: CASE WHEN len(list_filter(acc, lambda a: a.first_tok < s.end_tok AND s.first_tok < a.end_tok)) > 0
                          THEN acc ELSE list_append(acc, s) END,
      []::STRUCT(first_tok INTEGER, end_tok INTEGER, start INTEGER, stop INTEGER, label VARCHAR)[])), recursive := true)
  FROM matches GROUP BY sent_id)"""

CLASS_ID = "CASE label WHEN 'Medikation' THEN 0 WHEN 'Dosis' THEN 1 WHEN 'Diagnose' THEN 2 END"

GOLD_TAGS = f"""tagged AS (
  SELECT t.sent_id, t.i,
         coalesce(CASE WHEN f.first_tok = t.i THEN 2 * ({CLASS_ID.replace('label', 'f.label')}) + 1
                       ELSE 2 * ({CLASS_ID.replace('label', 'f.label')}) + 2 END, 0) AS gold
  FROM tokens t LEFT JOIN filtered f ON t.sent_id = f.sent_id AND f.first_tok <= t.i AND t.i < f.end_tok),
both_tags AS (
  SELECT sent_id, i, gold,
         CASE WHEN {unit(str(SEED), 'sent_id', 'i', "'flip'")} < 0.1
              THEN {draw('7', str(SEED), 'sent_id', 'i', "'tag'")} ELSE gold END AS pred
  FROM tagged)"""


def chunks_cte(name: str, src: str, tag: str) -> str:
    """Chunks of a (sent_id, i, tag) relation via lag + running sum."""
    return f"""{name}_flags AS (
  SELECT sent_id, i, {tag} AS tag,
         CASE WHEN {tag} <> 0 AND ({tag} % 2 = 1 OR lag({tag}, 1, 0) OVER w = 0
                   OR ({tag} + 1) // 2 <> (lag({tag}, 1, 0) OVER w + 1) // 2) THEN 1 ELSE 0 END AS st
  FROM {src} WINDOW w AS (PARTITION BY sent_id ORDER BY i)),
{name}_ids AS (
  SELECT *, sum(st) OVER (PARTITION BY sent_id ORDER BY i) AS cno FROM {name}_flags),
{name} AS (
  SELECT sent_id, CASE (min(tag) + 1) // 2 WHEN 1 THEN 'Medikation' WHEN 2 THEN 'Dosis' WHEN 3 THEN 'Diagnose' END AS type,
         min(i) AS first, max(i) AS last
  FROM {name}_ids WHERE tag <> 0 GROUP BY sent_id, cno)"""


PRF_FROM_CHUNKS = """cmp AS (
  SELECT coalesce(g.type, p.type) AS type,
         CASE WHEN g.sent_id IS NOT NULL THEN 1 ELSE 0 END AS is_gold,
         CASE WHEN p.sent_id IS NOT NULL THEN 1 ELSE 0 END AS is_pred
  FROM gold_chunks g FULL OUTER JOIN pred_chunks p
    ON g.sent_id = p.sent_id AND g.type = p.type AND g.first = p.first AND g.last = p.last),
agg AS (
  SELECT coalesce(type, 'overall') AS scope, sum(is_gold)::BIGINT AS n_gold, sum(is_pred)::BIGINT AS n_pred,
         sum(is_gold * is_pred)::BIGINT AS tp, grouping(type) AS is_total
  FROM cmp GROUP BY ROLLUP (type)),
prf AS (
  SELECT scope, n_gold, n_pred, tp,
         coalesce(tp / nullif(n_pred, 0), 0.0) AS precision,
         coalesce(tp / nullif(n_gold, 0), 0.0) AS recall
  FROM agg WHERE is_total = 1 OR n_gold + n_pred > 0)"""

PRF_SELECT = """SELECT scope, n_gold, n_pred, tp, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0), 6) AS f1 FROM prf"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def scoring_ctes() -> list[str]:
    return [SENTENCES, PIECES, TOKENS, phrase_keys_cte(), grams_cte(), MATCHES, FILTERED, GOLD_TAGS,
            chunks_cte("gold_chunks", "both_tags", "gold"), chunks_cte("pred_chunks", "both_tags", "pred")]


# --- batch 2: labelled sentences, lexicon sources, entity requests ----------

def joined(expr: str, order: str) -> str:
    return f"coalesce(array_to_string(list({expr} ORDER BY {order}), ','), '')"


RAW_SPANS = f"""raw_spans AS (
  SELECT s.doc_id, s.line_no, s.sent_id, s.sentence, r.ord::INTEGER AS ord,
         {draw('length(s.sentence)', str(SEED), 's.sent_id', 'r.ord', "'a'")} AS start,
         least({draw('length(s.sentence)', str(SEED), 's.sent_id', 'r.ord', "'a'")}
               + {draw('12', str(SEED), 's.sent_id', 'r.ord', "'b'")} + 1, length(s.sentence))::INTEGER AS stop,
         {draw('3', str(SEED), 's.sent_id', 'r.ord', "'c'")} AS ner_class
  FROM sentences s, range({draw('3', str(SEED), 's.sent_id', "'k'")} + 1) r(ord))"""

SPLIT_OF = (f"CASE WHEN {draw('10', str(SEED), 'doc_id', chr(39) + 'split' + chr(39))} < 8 THEN 'train' "
            f"WHEN {draw('10', str(SEED), 'doc_id', chr(39) + 'split' + chr(39))} = 8 THEN 'validation' ELSE 'test' END")

LABELLED = f"""labelled AS (
  SELECT doc_id, line_no, sent_id, sentence,
         {joined('ner_class', 'start, stop, ner_class, ord')} AS ner_class,
         {joined('start', 'start, stop, ner_class, ord')} AS start,
         {joined('stop', 'start, stop, ner_class, ord')} AS stop,
         {joined("CASE ner_class WHEN 0 THEN 'Medikation' WHEN 1 THEN 'Dosis' ELSE 'Diagnose' END",
                 'start, stop, ner_class, ord')} AS class_names,
         {SPLIT_OF} AS split
  FROM raw_spans GROUP BY doc_id, line_no, sent_id, sentence)"""

PIPE_LINES = f"""pipe_lines AS (
  SELECT p_partkey AS line_key,
         CASE WHEN {draw('10', str(SEED), 'p_partkey', "'short'")} = 0
              THEN concat_ws('|', p_partkey, p_type, p_size, p_brand, 'A', code, p_size)
              ELSE concat_ws('|', p_partkey, p_type, p_size, p_brand, 'A', code, p_size, ' ' || p_name || ' ') END AS value
  FROM (SELECT *, CASE WHEN {draw('13', str(SEED), 'p_partkey', "'blank'")} = 0 THEN '  ' ELSE 'C' || p_partkey END AS code
        FROM part))"""

SEMI_LINES = f"""semi_lines AS (
  SELECT p_partkey AS line_key,
         CASE WHEN {draw('10', str(SEED), 'p_partkey', "'short'")} = 0
              THEN concat_ws(';', p_partkey, flag, p_brand, p_type, p_size, 'D' || p_partkey, 'x', 'y')
              ELSE concat_ws(';', p_partkey, flag, p_brand, p_type, p_size, 'D' || p_partkey, 'x', 'y', p_name) END AS value
  FROM (SELECT *, CASE WHEN {draw('4', str(SEED), 'p_partkey', "'pad'")} = 0 THEN ' ' || f || chr(9) ELSE f END AS flag
        FROM (SELECT *, CASE WHEN {draw('3', str(SEED), 'p_partkey', "'flag'")} = 0 THEN 'N' ELSE 'T' END AS f FROM part)))"""


def ustrip_sql(x: str) -> str:
    from spanforge.functions.text import STRIP_PATTERN
    return f"regexp_replace({x}, {q(STRIP_PATTERN)}, '', 'g')"


def extract_cte(name: str, src: str, sep: str, min_fields: int, code_idx: int, term_idx: int,
                flag_idx: int | None = None) -> str:
    f = "string_split(regexp_replace(value, '[\\r\\n]+$', ''), " + q(sep) + ")"
    flag = (f"WHEN trim(fields[{flag_idx + 1}], ' ' || chr(9)) <> 'T' THEN 'not_terminal' " if flag_idx is not None else "")
    return f"""{name} AS (
  SELECT line_key, code, term,
         CASE WHEN len(fields) < {min_fields} THEN 'too_few' {flag}
              WHEN code = '' OR term = '' THEN 'empty' ELSE 'kept' END AS status
  FROM (SELECT line_key, fields,
               CASE WHEN len(fields) >= {min_fields} THEN {ustrip_sql(f'fields[{code_idx + 1}]')} END AS code,
               CASE WHEN len(fields) >= {min_fields} THEN {ustrip_sql(f'fields[{term_idx + 1}]')} END AS term
        FROM (SELECT line_key, {f} AS fields FROM {src})))"""


DOSE = f"""dose AS (
  SELECT 'A' || p_partkey AS atc_code, p_name AS atc_name,
         CASE WHEN dd <= 1 THEN NULL ELSE (p_size || '.' || ((p_partkey % 4) * 25))::DOUBLE END AS ddd,
         CASE WHEN du = 0 THEN NULL
              ELSE ['mg', 'ug', 'g', 'ml', 'IE'][{draw('5', str(SEED), 'p_partkey', "'unit'")} + 1] END AS uom,
         'O' AS adm_r, NULL::VARCHAR AS note
  FROM (SELECT *, {draw('7', str(SEED), 'p_partkey', "'ddd'")} AS dd, {draw('5', str(SEED), 'p_partkey', "'uom'")} AS du
        FROM part))"""

TERMS = f"""terms AS (
  SELECT 'I' || p_partkey AS ICD_Code,
         CASE WHEN {draw('9', str(SEED), 'p_partkey', "'q'")} = 0 THEN p_name || '; "Typ" B' ELSE p_name END AS Diagnose
  FROM part)"""


def py_float_sql(x: str) -> str:
    s = f"regexp_replace(CAST(CAST({x} AS DECIMAL(38,10)) AS VARCHAR), '0+$', '')"
    return f"CASE WHEN {s} LIKE '%.' THEN {s} || '0' ELSE {s} END"


# entity requests: texts under the drawn spans (+ a repeat, + a missing term)
REQUESTS = f"""req AS (
  SELECT sent_id, sentence, ord, substr(sentence, start + 1, stop - start) AS text,
         CASE ner_class WHEN 0 THEN 'Medikation' WHEN 1 THEN 'Dosis' ELSE 'Diagnose' END AS label
  FROM raw_spans
  UNION ALL
  SELECT sent_id, sentence, 100, substr(sentence, start + 1, stop - start),
         CASE ner_class WHEN 0 THEN 'Medikation' WHEN 1 THEN 'Dosis' ELSE 'Diagnose' END
  FROM raw_spans WHERE ord = 0 AND {draw('4', str(SEED), 'sent_id', "'dup'")} = 0
  UNION ALL
  SELECT sent_id, sentence, 200, 'zzqx', 'Diagnose'
  FROM sentences WHERE {draw('10', str(SEED), 'sent_id', "'miss'")} = 0),
req_ord AS (
  SELECT *, (row_number() OVER (PARTITION BY sent_id ORDER BY ord) - 1)::INTEGER AS pos FROM req)"""


# --- batch 3: spans (F) and token views (G) ----------------------------------

F1 = """f1 AS (
  SELECT sent_id, pos, text, label, (instr(lower(sentence), lower(text)) - 1)::INTEGER AS start,
         (instr(lower(sentence), lower(text)) - 1 + length(lower(text)))::INTEGER AS stop
  FROM req_ord)"""

F2 = """f2_base AS (
  SELECT *, (row_number() OVER (PARTITION BY sent_id, lower(text) ORDER BY pos) - 1)::INTEGER AS j,
         string_split(lower(sentence), lower(text)) AS parts
  FROM req_ord),
f2 AS (
  SELECT sent_id, pos, text, label, sentence,
         CASE WHEN j < len(parts) - 1
              THEN (list_sum(list_transform(parts[1:j + 1], lambda x: length(x))) + j * length(lower(text)))::INTEGER
              ELSE -1 END AS start, length(lower(text)) AS tlen
  FROM f2_base),
f2s AS (SELECT sent_id, pos, text, label, sentence, start, (start + tlen)::INTEGER AS stop FROM f2)"""

TAG_SQL = "'<class=\"([^\"]+)\">(.*?)</class>'"


def tagged_cte() -> str:
    from spanforge.plans.bindings import SEED as S
    med = "'<class=\"Medikation\">' || p_name || '</class>'"
    dose = "'<class=\"Dosis\">' || p_size || ' mg</class>'"
    diag = "'<class=\"Diagnose\">' || n_name || '</class>'"
    v = draw('3', str(S), 'p_partkey', "'tag'")
    return f"""tagged_src AS (
  SELECT p_partkey AS line_key, '<s>' || CASE WHEN {v} = 0 THEN 'Patient erhält ' || {med} || ' ' || {dose} || ' wegen ' || {diag} || '.'
                              WHEN {v} = 1 THEN {dose} || ' ' || {med} || '/' || {med} || ' 1-0-0'
                              ELSE 'Befund: ' || {diag} || ' ohne Therapie.' END || '</s>' AS value
  FROM part LEFT JOIN nation ON (p_partkey % 25) = n_nationkey),
tagged AS (SELECT line_key, replace(replace(value, '<s>', ''), '</s>', '') AS inner_text FROM tagged_src)"""


def filtered_cte(name: str, src: str, tie: str) -> str:
    return f"""{name} AS (
  SELECT sent_id, unnest(list_sort(list_reduce(
      list(struct_pack(first_tok := first_tok, end_tok := end_tok, start := start, stop := stop, label := label)
           ORDER BY end_tok - first_tok DESC, first_tok, {tie}),
      lambda acc, s: CASE WHEN len(list_filter(acc, lambda a: a.first_tok < s.end_tok AND s.first_tok < a.end_tok)) > 0
                          THEN acc ELSE list_append(acc, s) END,
      []::STRUCT(first_tok INTEGER, end_tok INTEGER, start INTEGER, stop INTEGER, label VARCHAR)[])), recursive := true)
  FROM {src} GROUP BY sent_id)"""


ALIGNED = """aligned AS (
  SELECT r.sent_id, r.ord, r.start AS c_start, r.stop AS c_stop, r.ner_class,
         min(t.i)::INTEGER AS first_tok, (max(t.i) + 1)::INTEGER AS end_tok,
         arg_min(t.start, t.i)::INTEGER AS start, arg_max(t.stop, t.i)::INTEGER AS stop
  FROM raw_spans r LEFT JOIN tokens t ON t.sent_id = r.sent_id AND t.stop > r.start AND t.start < r.stop
  GROUP BY r.sent_id, r.ord, r.start, r.stop, r.ner_class)"""

# model-input view: [CLS] + word tokens + [SEP]; specials have (0, 0)
SEQ = """seq AS (
  SELECT sent_id, i + 1 AS p, token, start, stop FROM tokens
  UNION ALL SELECT sent_id, 0, '[CLS]', 0, 0 FROM sentences
  UNION ALL SELECT s.sent_id, coalesce(c.n, 0) + 1, '[SEP]', 0, 0
  FROM sentences s LEFT JOIN (SELECT sent_id, count(*) AS n FROM tokens GROUP BY sent_id) c USING (sent_id))"""

# the same cut at 128 places
SEQ_128 = """seq AS (
  SELECT sent_id, i + 1 AS p, token, start, stop FROM tokens WHERE i < 126
  UNION ALL SELECT sent_id, 0, '[CLS]', 0, 0 FROM sentences
  UNION ALL SELECT s.sent_id, least(coalesce(c.n, 0), 126) + 1, '[SEP]', 0, 0
  FROM sentences s LEFT JOIN (SELECT sent_id, count(*) AS n FROM tokens GROUP BY sent_id) c USING (sent_id))"""

ENT_RANK = """ents_ranked AS (
  SELECT sent_id, start, stop, ner_class,
         row_number() OVER (PARTITION BY sent_id ORDER BY start, stop, ner_class, ord) AS er
  FROM raw_spans)"""


def seq_labels_cte(last: bool) -> str:
    pick = "arg_max" if last else "arg_min"
    return f"""seq_lab AS (
  SELECT q.sent_id, q.p, q.token,
         CASE WHEN q.start = q.stop THEN -100
              WHEN count(e.er) = 0 THEN 0
              WHEN {pick}(e.start, e.er) = q.start THEN 2 * {pick}(e.ner_class, e.er) + 1
              ELSE 2 * {pick}(e.ner_class, e.er) + 2 END AS lab
  FROM seq q LEFT JOIN ents_ranked e ON e.sent_id = q.sent_id AND q.start <> q.stop
       AND e.start <= q.start AND q.stop <= e.stop
  GROUP BY q.sent_id, q.p, q.token, q.start, q.stop)"""


# --- batch 4: draws, prompts, responses ----------------------------------------

def _lit_list(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def gen_lexica() -> list[str]:
    return [
        "meds AS (SELECT (row_number() OVER (ORDER BY p_name, p_partkey) - 1)::INTEGER AS idx, p_name AS term FROM part)",
        "diags AS (SELECT (row_number() OVER (ORDER BY n_name, n_nationkey) - 1)::INTEGER AS idx, n_name AS term "
        "FROM nation)",
        f"vals AS (SELECT (row_number() OVER (ORDER BY p_partkey) - 1)::INTEGER AS idx, "
        f"{py_float_sql('(p_size + (p_partkey % 4) * 0.25)')} AS term FROM part)",
        "units AS (SELECT (row_number() OVER (ORDER BY p_partkey) - 1)::INTEGER AS idx, lower(p_type) AS term FROM part)",
        "lex_n AS (SELECT (SELECT count(*) FROM meds) AS nm, (SELECT count(*) FROM diags) AS nd, "
        "(SELECT count(*) FROM vals) AS nv, (SELECT count(*) FROM units) AS nu)",
    ]


def shapes_cte(shapes) -> str:
    vals = ", ".join(f"({i}, {_lit_list(s)})" for i, s in enumerate(shapes))
    return f"shapes AS (SELECT * FROM (VALUES {vals}) v(shape_id, shape))"


def fixed_slots() -> list[str]:
    from spanforge.schemas import SHAPES
    S = str(SEED)
    return [shapes_cte(SHAPES), f"""slots AS (
  SELECT row_id, (generate_subscripts(shape, 1) - 1)::INTEGER AS slot, unnest(shape) AS label FROM (
    SELECT o_orderkey AS row_id, shape FROM orders JOIN shapes ON shape_id = {draw('7', S, 'o_orderkey', "'shape'")}))"""]


def random_shape_ctes(rows: str) -> list[str]:
    """``rs(row_id, label, slot)``: a random shape for each row_id of ``rows``."""
    S = str(SEED)
    nm = f"[0, 1, 1, 2][{draw('4', S, 'row_id', "'n_med'")} + 1]"
    nd = f"[0, 1, 1, 2][{draw('4', S, 'row_id', "'n_diag'")} + 1]"
    nz = f"CASE WHEN {nm} > 0 THEN [0, 1][{draw('2', S, 'row_id', "'n_dose'")} + 1] ELSE 0 END"
    return [f"rs_n AS (SELECT row_id, {nm} AS nm, {nd} AS nd, {nz} AS nz FROM ({rows}))",
            "rs_l AS (SELECT row_id, CASE WHEN nm + nd + nz = 0 THEN ['Diagnose'] ELSE "
            "list_concat(list_concat(list_transform(range(nm), lambda x: 'Medikation'), "
            "list_transform(range(nz), lambda x: 'Dosis')), list_transform(range(nd), lambda x: 'Diagnose')) END AS labels "
            "FROM rs_n)",
            "rs_e AS (SELECT row_id, unnest(labels) AS label, generate_subscripts(labels, 1) - 1 AS i FROM rs_l)",
            f"rs AS (SELECT row_id, label, (row_number() OVER (PARTITION BY row_id ORDER BY "
            f"md5(concat_ws('|', {S}, row_id, i, 'perm')), label) - 1)::INTEGER AS slot FROM rs_e)"]


def pooled_slots() -> list[str]:
    """Slots of shapes from the pool of 100."""
    return [*random_shape_ctes("SELECT unnest(range(100)) AS row_id"),
            f"slots AS (SELECT o_orderkey AS row_id, slot, label FROM orders JOIN rs ON rs.row_id = "
            f"{draw('100', str(SEED), 'o_orderkey', chr(39) + 'pool' + chr(39))})"]


FALLBACK_DIAGS = ("diags AS (SELECT (row_number() OVER (ORDER BY p_partkey) - 1)::INTEGER AS idx, p_type AS term FROM part)")


def gen_slots(slots: list[str] | None = None, diags: str | None = None) -> list[str]:
    S = str(SEED)
    lexica = [diags if diags and c.startswith("diags AS") else c for c in gen_lexica()]
    return lexica + (fixed_slots() if slots is None else slots) + [
                           f"""slot_text AS (
  SELECT s.row_id, s.slot, s.label,
         CASE s.label WHEN 'Medikation' THEN m.term WHEN 'Diagnose' THEN dg.term
              ELSE replace(v.term || CASE WHEN {unit(S, 's.row_id', 's.slot', "'space'")} < 0.7 THEN '' ELSE ' ' END
                           || u.term, '.', ',') END AS text
  FROM slots s CROSS JOIN lex_n
  LEFT JOIN meds m ON m.idx = {draw('lex_n.nm', S, 's.row_id', 's.slot', "'med'")}
  LEFT JOIN diags dg ON dg.idx = {draw('lex_n.nd', S, 's.row_id', 's.slot', "'diag'")}
  LEFT JOIN vals v ON v.idx = {draw('lex_n.nv', S, 's.row_id', 's.slot', "'val'")}
  LEFT JOIN units u ON u.idx = {draw('lex_n.nu', S, 's.row_id', 's.slot', "'unit'")})"""]


def pool_cte() -> str:
    from spanforge.schemas import ORIGINAL_SENTENCES
    vals = ", ".join(f"({i}, {q(s)})" for i, s in enumerate(ORIGINAL_SENTENCES))
    tag = "'<class=\"([^\"]+)\">(.*?)</class>'"
    return f"""pool AS (
  SELECT i, '{{"text": "' || regexp_replace(inner_t, {tag}, '\\2', 'g') || '", "entities": [' ||
         array_to_string(list_transform(range(len(regexp_extract_all(inner_t, {tag}, 1))),
             lambda k: '{{"text": "' || regexp_extract_all(inner_t, {tag}, 2)[k + 1] || '", "label": "'
                       || regexp_extract_all(inner_t, {tag}, 1)[k + 1] || '"}}'), ', ') || ']}}' AS js
  FROM (SELECT i, replace(replace(tagged, '<s>', ''), '</s>', '') AS inner_t FROM (VALUES {vals}) v(i, tagged)))"""


def prompt_ctes() -> list[str]:
    from spanforge.schemas import CONTEXTS, FORMAT_LINES, STYLES
    S = str(SEED)
    return gen_slots() + [pool_cte(), f"""picks AS (
  SELECT row_id, js, k FROM (
    SELECT o.o_orderkey AS row_id, p.js, md5(concat_ws('|', {S}, o.o_orderkey, p.i, 'ex')) AS k,
           row_number() OVER (PARTITION BY o.o_orderkey ORDER BY md5(concat_ws('|', {S}, o.o_orderkey, p.i, 'ex')), p.i) AS rk
    FROM orders o CROSS JOIN pool p) WHERE rk <= 2)""",
        "examples AS (SELECT row_id, 'Beispiel Sätze:' || chr(10) || string_agg(js, chr(10) ORDER BY k) AS ex "
        "FROM picks GROUP BY row_id)",
        "task AS (SELECT row_id, 'Begriffe:' || chr(10) || string_agg('- ' || label || ': ' || text, chr(10) "
        "ORDER BY slot) AS task FROM slot_text GROUP BY row_id)",
        f"""prompt_parts AS (
  SELECT t.row_id, t.task, e.ex,
         'Formuliere als: ' || {_lit_list(STYLES)}[{draw('5', S, 't.row_id', "'style'")} + 1] || '. ' || chr(10) ||
         'Kontext: ' || {_lit_list(CONTEXTS)}[{draw('6', S, 't.row_id', "'ctx'")} + 1] || '. ' AS sc,
         'Format:' || chr(10) || {q(FORMAT_LINES['script'])} AS fmt
  FROM task t JOIN examples e USING (row_id))"""]


def responses_ctes() -> list[str]:
    from spanforge.functions.text import FENCE
    S = str(SEED)
    return gen_slots() + [f"""resp0 AS (
  SELECT row_id, {draw('10', S, 'row_id', "'resp'")} AS v,
         'Patient ' || string_agg(text, ' und ' ORDER BY slot) || '.' AS sent0,
         arg_min(text, slot) AS first_text,
         string_agg('{{"text": "' || text || '", "label": "' || label || '"}}', ', ' ORDER BY slot) AS ent_json
  FROM slot_text GROUP BY row_id)""", """resp1 AS (
  SELECT row_id, v, CASE WHEN v = 3 THEN replace(sent0, first_text, 'etwas') ELSE sent0 END AS plain, ent_json
  FROM resp0)""", """resp AS (
  SELECT row_id, v, plain, CASE v WHEN 0 THEN '```json' || chr(10) || js || chr(10) || '```'
                                  WHEN 1 THEN substr(js, 1, length(js) - 5)
                                  WHEN 2 THEN '{"entities": []}'
                                  WHEN 4 THEN '  ' || js || chr(10) ELSE js END AS raw
  FROM (SELECT *, '{"text": "' || plain || '", "entities": [' || ent_json || ']}' AS js FROM resp1))""",
        f"""parsed AS (
  SELECT row_id, plain, raw, clean,
         CASE WHEN NOT json_valid(clean) THEN 'bad_json'
              WHEN json_type(clean) = 'OBJECT' AND json_type(clean, '$.text') = 'VARCHAR' THEN 'ok'
              ELSE 'no_text' END AS status
  FROM (SELECT *, regexp_replace({ustrip_sql('raw')}, {q(FENCE)}, '', 'g') AS clean FROM resp))""",
        """gen_req AS (
  SELECT s.row_id AS sent_id, p.status, CASE WHEN p.status = 'ok' THEN json_extract_string(p.clean, '$.text') END
         AS sentence, s.slot AS pos, s.text, s.label
  FROM slot_text s JOIN parsed p USING (row_id))""",
        """gen_f2_base AS (
  SELECT *, (row_number() OVER (PARTITION BY sent_id, lower(text) ORDER BY pos) - 1)::INTEGER AS j,
         string_split(lower(sentence), lower(text)) AS parts
  FROM gen_req WHERE sentence IS NOT NULL)""",
        """gen_f2 AS (
  SELECT sent_id, pos, label, sentence,
         CASE WHEN j < len(parts) - 1
              THEN (list_sum(list_transform(parts[1:j + 1], lambda x: length(x))) + j * length(lower(text)))::INTEGER
              ELSE -1 END AS start, length(lower(text)) AS tlen
  FROM gen_f2_base)""",
        """final AS (
  SELECT p.row_id, p.status, CASE WHEN p.status <> 'ok' THEN p.status
                                  WHEN bool_or(f.start = -1) THEN 'unmatched' ELSE 'accepted' END AS final_status
  FROM parsed p LEFT JOIN gen_f2 f ON f.sent_id = p.row_id GROUP BY p.row_id, p.status)"""]
