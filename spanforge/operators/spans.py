"""Span finding, inline-tag parsing, span QA, token alignment, de-overlap
(F1–F8, G2, G3, G4 helpers).

All per-sentence work stays in array higher-order functions: a sentence's
spans and tokens live in one row, so nothing is exploded or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.functions.arrays import count_leading, let
from spanforge.functions.labels import class_id
from spanforge.functions.text import TAG

_SPAN_T = "struct<start:int,stop:int,label:string,ord:int>"


def find_spans_first(sentence: Column, entities: Column, low: Column | None = None) -> Column:
    """first case-insensitive occurrence of every entity text (no word
    boundary); a repeated term gets the same span.  Miss: start -1.

    ``low``: the lowered sentence as a materialised column, else it is lowered for
    each entity."""
    low = F.lower(sentence) if low is None else low

    def one(e, k):
        t = F.lower(e["text"])
        start = F.call_function("locate", t, low) - 1  # locate: 1-based, 0 = miss
        return F.struct(start.cast("int").alias("start"), (start + F.length(t)).cast("int").alias("stop"),
                        e["label"].alias("label"), k.alias("ord"))
    return F.transform(entities, one)


def find_spans_next(sentence: Column, entities: Column, low: Column | None = None) -> Column:
    """each repeated (lower-cased) term continues after its previous hit;
    a miss (start -1, stop len-1) does not advance the search position.

    Fold state: map term -> next search position (1-based) and the spans so
    far; entity lists are short (a handful), so the fold is cheap."""
    low = F.lower(sentence) if low is None else low
    init = F.struct(
        F.create_map().cast("map<string,int>").alias("pos"),
        F.array().cast(f"array<{_SPAN_T}>").alias("spans"))

    def step(acc, e):
        t = F.lower(e["text"])
        from_pos = F.coalesce(F.try_element_at(acc["pos"], t), F.lit(1))
        found = F.call_function("locate", t, low, from_pos) - 1
        stop = found + F.length(t)
        k = F.size(acc["spans"])
        span = F.struct(found.cast("int").alias("start"), stop.cast("int").alias("stop"),
                        e["label"].alias("label"), k.cast("int").alias("ord"))
        new_pos = F.when(found >= 0, F.map_concat(
            F.map_filter(acc["pos"], lambda key, v: key != t), F.create_map(t, (stop + 1).cast("int")))
        ).otherwise(acc["pos"])
        return F.struct(new_pos.alias("pos"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return F.aggregate(entities, init, step, lambda acc: acc["spans"])


def sort_spans(spans: Column) -> Column:
    """stable sort by start (ties keep request order); a miss sorts first."""
    return F.array_sort(spans, lambda a, b: F.when(a["start"] < b["start"], -1)
                        .when(a["start"] > b["start"], 1)
                        .when(a["ord"] < b["ord"], -1)
                        .when(a["ord"] > b["ord"], 1).otherwise(0))


def spans_to_labels(spans: Column) -> Column:
    """F3 tail: parallel lists (ner_class ids, start, stop) of sorted spans."""
    s = sort_spans(spans)
    return F.struct(F.transform(s, lambda x: class_id(x["label"])).alias("ner_class"),
                    F.transform(s, lambda x: x["start"]).alias("start"),
                    F.transform(s, lambda x: x["stop"]).alias("stop"))


def has_unmatched(spans: Column) -> Column:
    """E6 predicate: any requested term not found."""
    return F.exists(spans, lambda s: s["start"] == -1)


def parse_tags(tagged: Column) -> Column:
    """inline ``<class="L">term</class>`` tags -> array<struct<text,label>>,
    non-greedy, left to right (after removing ``<s>``/``</s>``)."""
    inner = F.replace(F.replace(tagged, F.lit("<s>"), F.lit("")), F.lit("</s>"), F.lit(""))
    texts = F.regexp_extract_all(inner, F.lit(TAG), F.lit(2))
    labels = F.regexp_extract_all(inner, F.lit(TAG), F.lit(1))
    return F.zip_with(texts, labels, lambda t, lab: F.struct(t.alias("text"), lab.alias("label")))


def strip_tags(tagged: Column) -> Column:
    """plain text of a tagged sentence."""
    inner = F.replace(F.replace(tagged, F.lit("<s>"), F.lit("")), F.lit("</s>"), F.lit(""))
    return F.regexp_replace(inner, F.lit(TAG), F.lit("$2"))


def span_text(sentence: Column, start: Column, stop: Column) -> Column:
    """``sentence[start:stop]`` (code points)."""
    return F.substring(sentence, start + 1, stop - start)


# --- token alignment and de-overlap -----------------------------------------

def align_expand(tokens: Column, start: Column, stop: Column) -> Column:
    """Character span -> token span covering every partially covered token.
    Returns struct(first_tok, end_tok) or NULL when no token overlaps.

    Tokens lie side by side in text order, so both borders are found by binary search:
    O(log n) looks into the token array for a span."""
    first = count_leading(tokens, lambda t: t["stop"] <= start)
    end = count_leading(tokens, lambda t: t["start"] < stop)
    return let(F.struct(first.alias("f"), end.alias("e")), lambda r: F.when(r["f"] < r["e"], F.struct(
        r["f"].alias("first_tok"), r["e"].alias("end_tok"), F.get(tokens, r["f"])["start"].alias("start"),
        F.get(tokens, r["e"] - 1)["stop"].alias("stop"))))


def filter_spans(spans: Column) -> Column:
    """Drop overlapping token spans — longest first, ties to the earliest start,
    then to the span that comes first in the input; greedy; result ordered by start.

    ``spans``: array<struct<first_tok,end_tok,...>> with end exclusive.  The kept spans are a disjoint set sorted by
    start, so the only one that may clash is found by binary search, and a span is put
    in its place: O(m log m) comparisons whatever overlaps."""
    def ordered(a):
        return F.sort_array(F.transform(a, lambda s, i: F.struct(
            (s["first_tok"] - s["end_tok"]).alias("neg_len"), s["first_tok"].alias("first_tok"), i.alias("i"), s.alias("s"))))

    def keep(kept, x):
        s = x["s"]

        def put(before):
            clash = (before > 0) & (F.get(kept, before - 1)["end_tok"] > s["first_tok"])
            return F.when(clash, kept).otherwise(F.concat(
                F.slice(kept, F.lit(1), before), F.array(s), F.slice(kept, before + 1, F.size(kept))))
        return let(count_leading(kept, lambda k: k["first_tok"] < s["end_tok"]), put)

    return let(spans, lambda a: F.aggregate(ordered(a), F.slice(a, 1, 0), keep))


def explode_spans(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """posexplode_outer + null filter (see tokens.explode_tokens)."""
    return (df.select(*keys, F.posexplode_outer(col).alias("pos", "__s")).where(F.col("__s").isNotNull())
            .select(*keys, "pos", "__s.*"))
