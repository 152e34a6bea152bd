"""Prompt and chat assembly (D1–D8) — bulk string building in SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanforge.schemas import (CONTEXT_PREFIX, EXAMPLES_HEADER, FORMAT_HEADER, FORMAT_LINES, STYLE_PREFIX,
                               SYSTEM_PROMPT, SYSTEM_PROMPT_EARLY, SYSTEM_PROMPT_SENTENCE, TASK_HEADER)


def json_str(s: Column) -> Column:
    """A JSON string literal as ``json.dumps(..., ensure_ascii=False)`` writes it:
    backslash, quote and every control character below U+0020 escaped."""
    named = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}
    e = F.replace(s, F.lit("\\"), F.lit("\\\\"))
    e = F.replace(e, F.lit('"'), F.lit('\\"'))
    plain = e
    for code in range(32):
        e = F.replace(e, F.lit(chr(code)), F.lit(named.get(code, f"\\u{code:04x}")))
    # control characters are rare: most strings skip the replacements
    e = F.when(plain.rlike("[\\x00-\\x1f]"), e).otherwise(plain)
    return F.concat(F.lit('"'), e, F.lit('"'))


def example_json(text: Column, entities: Column) -> Column:
    """D3 element: ``{"text": ..., "entities": [{"text": ..., "label": ...}, ...]}``
    with Python's default separators (", " and ": ")."""
    ents = F.transform(entities, lambda e: F.concat(F.lit('{"text": '), json_str(e["text"]),
                                                    F.lit(', "label": '), json_str(e["label"]), F.lit("}")))
    return F.concat(F.lit('{"text": '), json_str(text), F.lit(', "entities": ['), F.array_join(ents, ", "),
                    F.lit("]}"))


def task_block(entities: Column) -> Column:
    """Header line + ``- label: text`` per entity."""
    lines = F.transform(entities, lambda e: F.concat(F.lit("- "), e["label"], F.lit(": "), e["text"]))
    return F.array_join(F.concat(F.array(F.lit(TASK_HEADER)), lines), "\n")


def format_block(variant: str = "script") -> Column:
    """Format instructions (three wordings)."""
    return F.lit(FORMAT_HEADER + "\n" + FORMAT_LINES[variant])


def examples_block(example_jsons: Column) -> Column:
    """Header + one JSON example per line."""
    return F.array_join(F.concat(F.array(F.lit(EXAMPLES_HEADER)), example_jsons), "\n")


def style_line(style: Column, context: Column) -> Column:
    return F.concat(F.lit(STYLE_PREFIX), style, F.lit(". \n" + CONTEXT_PREFIX), context, F.lit(". "))


#: variant -> (system text of an inline header, style line?, format wording)
VARIANTS = {
    "script": (None, True, "script"),
    "system": (SYSTEM_PROMPT, True, "script"),
    "no_format": (SYSTEM_PROMPT_SENTENCE, True, None),
    "system_no_style": (SYSTEM_PROMPT, False, "label_list"),
    "bare": (None, False, "label_list"),
}


def header(system: str) -> str:
    return "System: " + system + "\n\nUser:\n"


def build_prompt(task: Column, style: Column, context: Column, examples: Column,
                 variant: str = "script") -> Column:
    """Full user prompt of a variant (``VARIANTS``): optional inline system
    header, task, optional style line, optional format block, examples; blocks are
    set apart by blank lines."""
    system, styled, wording = VARIANTS[variant]
    blocks = [task] + [style_line(style, context)] * styled + ([format_block(wording)] if wording else []) + [examples]
    head = [F.lit(header(system))] if system else []
    return F.concat(*head, F.concat_ws("\n\n", *blocks), F.lit("\n"))


def chat_messages(user: Column, system: Column | None = None) -> Column:
    """``[{role: system, content}, {role: user, content}]``."""
    sys_c = system if system is not None else F.lit(SYSTEM_PROMPT)
    return F.array(F.struct(F.lit("system").alias("role"), sys_c.alias("content")),
                   F.struct(F.lit("user").alias("role"), user.alias("content")))


def fold_system(user: Column, system: Column | None = None) -> Column:
    """A single user turn carrying ``system + blank line + user``."""
    sys_c = system if system is not None else F.lit(SYSTEM_PROMPT)
    return F.array(F.struct(F.lit("user").alias("role"), F.concat(sys_c, F.lit("\n\n"), user).alias("content")))


def build_prompt_fixed_examples(task: Column) -> Column:
    """D4 (+D6, D2 notebook wording): the early notebook prompt — inline
    System/User header, task, format, and the fixed two-example block, one
    example per line."""
    from spanforge.schemas import FIXED_EXAMPLES
    block = EXAMPLES_HEADER + "\n" + "".join(e + "\n" for e in FIXED_EXAMPLES)
    return F.concat(F.lit(header(SYSTEM_PROMPT_EARLY)), task, F.lit("\n\n"),
                    format_block("notebook"), F.lit("\n\n" + block))
