"""Golden cases read off the reference's inline checks (FIXTURES.md §2, §3)."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanforge.functions import labels as L
from spanforge.functions.text import py_float_text
from spanforge.operators import bio, metrics, sampling, spans, tokens
from spanforge.operators.matching import local_matches, match_pattern, percentage_tokens, prepare_phrases
from spanforge.operators.matching import collect_lexicon
from spanforge.operators.responses import json_status
from spanforge.functions.text import strip_fence


def one(spark, expr, schema="x string", row=("",)):
    return spark.createDataFrame([row], schema).select(expr.alias("r")).first()["r"]


def test_label_maps(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (-1,)], "i int")
    got = [r[0] for r in df.select(L.class_name(F.col("i"))).collect()]
    assert got == ["Medikation", "Dosis", "Diagnose", None, None]
    assert one(spark, L.class_id(F.lit("Dosis"))) == 1
    assert one(spark, L.class_id(F.lit("Symptom"))) is None
    assert one(spark, L.bio_tag(F.lit(6))) == "I-Diagnose"


def test_offset_format(spark):
    from spanforge.operators.lexicon import to_offset_format
    df = spark.createDataFrame([("Test", ([0], [0], [2]))],
                               "sentence string, ner_labels struct<ner_class:array<int>,start:array<int>,stop:array<int>>")
    r = to_offset_format(df).first()
    assert (r["text"], r["ent_starts"], r["ent_stops"], r["ent_classes"]) == ("Test", [0], [2], ["Medikation"])


def _labels(spark, offsets, ents, last=False):
    df = spark.createDataFrame([(offsets, ents)],
                               "o array<struct<start:int,stop:int>>, e array<struct<start:int,stop:int,class_id:int>>")
    return df.select(bio.token_labels(F.col("o"), F.col("e"), last)).first()[0]


def test_token_labels(spark):
    assert _labels(spark, [(0, 4)], [(0, 8, 0)]) == [1]
    assert _labels(spark, [(3, 8)], [(0, 8, 0)]) == [2]
    assert _labels(spark, [(0, 0), (0, 7), (8, 13), (0, 0)], [(0, 7, 0), (8, 13, 1)]) == [-100, 1, 3, -100]
    # overlapping entities: first vs last match
    assert _labels(spark, [(0, 8)], [(0, 8, 0), (0, 8, 1)]) == [1]
    assert _labels(spark, [(0, 8)], [(0, 8, 0), (0, 8, 1)], last=True) == [3]
    # token straddling the entity end
    assert _labels(spark, [(5, 10)], [(0, 8, 0)]) == [0]


def _spans(spark, sentence, terms, fn):
    df = spark.createDataFrame([(sentence, [(t, "Medikation") for t in terms])],
                               "s string, e array<struct<text:string,label:string>>")
    return [(x["start"], x["stop"]) for x in df.select(fn(F.col("s"), F.col("e"))).first()[0]]


def test_find_spans(spark):
    s = "0,5mg Digoxin 0,25mg Lanatoside"
    assert _spans(spark, s, ["0,5mg", "Digoxin", "0,25mg", "Lanatoside"], spans.find_spans_next) == \
        [(0, 5), (6, 13), (14, 20), (21, 31)]
    s = "0,5mg Sildenafil bei erectilen Dysfunktion"
    assert _spans(spark, s, ["0,5mg", "Sildenafil", "erectilen Dysfunktion"], spans.find_spans_next) == \
        [(0, 5), (6, 16), (21, 42)]
    assert _spans(spark, "Gicht und GICHT", ["Gicht", "Gicht"], spans.find_spans_first) == [(0, 5), (0, 5)]
    assert _spans(spark, "Gicht und GICHT", ["Gicht", "Gicht"], spans.find_spans_next) == [(0, 5), (10, 15)]
    assert _spans(spark, "Gicht", ["Asthma"], spans.find_spans_next) == [(-1, 5)]
    # code points: an astral character before the hit counts as one
    assert _spans(spark, "\U0001F600 Gicht", ["Gicht"], spans.find_spans_first) == [(2, 7)]


def test_parse_and_strip_tags(spark):
    tagged = ('<s><class="Medikation">Valsartan</class>/<class="Medikation">HCT</class> '
              '<class="Dosis">160</class>/<class="Dosis">12,5 mg</class> 1-0-0</s>')
    df = spark.createDataFrame([(tagged,)], "t string")
    r = df.select(spans.strip_tags(F.col("t")).alias("x"), spans.parse_tags(F.col("t")).alias("e")).first()
    assert r["x"] == "Valsartan/HCT 160/12,5 mg 1-0-0"
    assert [e["label"] for e in r["e"]] == ["Medikation", "Medikation", "Dosis", "Dosis"]


def test_filter_spans(spark):
    df = spark.createDataFrame([([(0, 2, "A"), (1, 4, "A"), (3, 5, "A"), (4, 5, "A")],)],
                               "s array<struct<first_tok:int,end_tok:int,label:string>>")
    got = [(x["first_tok"], x["end_tok"]) for x in df.select(spans.filter_spans(F.col("s"))).first()[0]]
    assert got == [(1, 4), (4, 5)]


def test_detokenize_and_slice(spark):
    df = spark.createDataFrame([(["spaCy", "is", "cool", "!"], [True, True, False, False])],
                               "w array<string>, s array<boolean>")
    assert df.select(tokens.detokenize(F.col("w"), F.col("s"))).first()[0] == "spaCy is cool!"
    t = tokens.tokenize(spark.createDataFrame([("I like David Bowie",)], "sentence string"))
    assert t.select(tokens.token_slice_text(F.col("sentence"), F.col("tokens"), F.lit(2), F.lit(4))).first()[0] == \
        "David Bowie"


def _tok(spark, text):
    return tokens.tokenize(spark.createDataFrame([(1, text)], "sent_id long, sentence string"))


def test_patterns(spark):
    t = _tok(spark, "In 1990, more than 60% of people in East Asia were in extreme poverty. "
                    "Now less than 4% are.")
    assert [r["token"] for r in percentage_tokens(t, ["sent_id"]).collect()] == ["60", "4"]
    t = _tok(spark, "Upcoming iPhone X release date leaked as Apple reveals pre-orders")
    m = match_pattern(t, ["sent_id"], [("IPHONE_X", [("TEXT", "iPhone"), ("TEXT", "X")])])
    assert [r["match_text"] for r in m.collect()] == ["iPhone X"]
    t = _tok(spark, "After making the iOS update you won't notice a radical system-wide redesign: nothing like "
                    "the aesthetic upheaval we got with iOS 7. Most of iOS 11's furniture remains the same as in "
                    "iOS 10. But you will discover some tweaks once you delve a little deeper.")
    m = match_pattern(t, ["sent_id"], [("IOS", [("TEXT", "iOS"), ("IS_DIGIT", None)])])
    assert sorted(r["match_text"] for r in m.collect()) == ["iOS 10", "iOS 11", "iOS 7"]


def test_phrase_match(spark):
    t = _tok(spark, "I have a cat and a Golden Retriever")
    lex = prepare_phrases(spark.createDataFrame([("cat", "ANIMAL"), ("Golden Retriever", "ANIMAL"), ("dog", "ANIMAL")],
                                                "phrase string, label string"))
    m = t.select(F.inline_outer(local_matches(F.col("tokens"), collect_lexicon(lex, 100)))).collect()
    assert sorted(r["key"] for r in m) == ["Golden Retriever", "cat"]
    from spanforge.operators.matching import phrase_match_join
    assert sorted(r["key"] for r in phrase_match_join(t, lex, ["sent_id"]).collect()) == ["Golden Retriever", "cat"]
    with pytest.raises(ValueError, match="phrase_match_join"):
        collect_lexicon(lex, 2)


def test_bio_chunks(spark):
    # B-A I-A O I-B I-A B-A with A = Medikation (1/2), B = Dosis (3/4)
    df = spark.createDataFrame([([1, 2, 0, 4, 2, 1],)], "t array<int>")
    got = [(c["type"], c["first"], c["last"]) for c in df.select(bio.bio_chunks(F.col("t"))).first()[0]]
    assert got == [("Medikation", 0, 1), ("Dosis", 3, 3), ("Medikation", 4, 4), ("Medikation", 5, 5)]


def test_prf_no_predictions(spark):
    df = spark.createDataFrame([([("Dosis", 0, 1)], [])],
                               "g array<struct<type:string,first:int,last:int>>, p array<struct<type:string,first:int,last:int>>")
    r = {x["scope"]: x for x in metrics.ner_prf(df, "g", "p").collect()}
    assert (r["overall"]["precision"], r["overall"]["recall"], r["overall"]["f1"]) == (0.0, 0.0, 0.0)


def test_population_std(spark):
    df = spark.createDataFrame([("f1", 1.0), ("f1", 2.0), ("f1", 4.0)], "metric string, value double")
    r = metrics.seed_mean_std(df, ["metric"]).first()
    assert round(r["mean"], 6) == 2.333333 and round(r["std"], 6) == 1.247219


def test_dosage_and_nan(spark):
    assert one(spark, py_float_text(F.lit(30.0))) == "30.0"
    assert one(spark, py_float_text(F.lit(1e7))) == "10000000.0"
    assert one(spark, sampling.dosage_text(F.lit("30.0"), F.lit("mg"), 42, F.lit(1), 0)) in ("30,0mg", "30,0 mg")
    from spanforge.operators.lexicon import as_strings
    assert one(spark, as_strings(F.lit(None).cast("double"), numeric=True)) == "nan"


def test_json_guard(spark):
    cases = ['{"text":"a"} x', "{'text':'a'}", '{"text":5}', "[1]", '{"x":1}', '{"text": "ok"}',
             '```json\n{"text": "ok"}\n```']
    df = spark.createDataFrame([(c,) for c in cases], "raw string")
    got = [r[0] for r in df.select(json_status(strip_fence(F.col("raw")))).collect()]
    assert got == ["bad_json", "bad_json", "no_text", "no_text", "no_text", "ok", "ok"]
    more = ['{"text": "x", "p": NaN}', '{"text": "x", "p": [-Infinity, 1]}', '{"text": "a", "text": "b"}', "NaN x"]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in more], "raw string").select(json_status(F.col("raw"))).collect()]
    assert got == ["ok", "ok", "bad_json", "bad_json"]


def test_code_lines(spark):
    from spanforge.sources.readers import extract_codes
    lines = spark.createDataFrame([("0|1|2|3|4|C1|6| term ",), ("0|1|2|3|4|C2|6",), ("0|1|2|3|4| |6|x",)], "value string")
    got = [(r["code"], r["term"], r["status"]) for r in extract_codes(lines, "[|]", 8, 5, 7).collect()]
    assert got == [("C1", "term", "kept"), (None, None, "too_few"), ("", "x", "empty")]


def test_retry_policy():
    from spanforge.operators.responses import CallError, ask
    seen, sleeps = [], []

    def failing(codes):
        def call(prompt, system, attempt):
            seen.append((prompt, system, attempt))
            if attempt <= len(codes):
                raise CallError(codes[attempt - 1])
            return "ok"
        return call
    got = ask(failing([503, 429]), "p", "rules", sleep=sleeps.append, jitter=lambda: 0.5)
    assert (got.text, got.attempts, got.code, got.error) == ("ok", 3, 200, None)
    assert seen == [("p", "rules", 1), ("p", "rules", 2), ("p", "rules", 3)] and sleeps == [2.5, 4.5]
    got = ask(failing([400]), "p", "s", sleep=sleeps.append)
    assert (got.text, got.attempts, got.code, got.error) == (None, 1, 400, "status 400") and len(sleeps) == 2
    got = ask(failing([429] * 9), "p", "s", sleep=sleeps.append, jitter=lambda: 0.0)
    assert (got.attempts, got.code) == (6, 429) and sleeps[2:] == [2.0, 4.0, 8.0, 16.0, 32.0]


def test_ties_keep_input_order(spark):
    rows = [([(0, 2, "Medikation"), (0, 2, "Diagnose"), (4, 5, "Dosis")],), ([(3, 4, "a"), (0, 1, "b")],), ([],)]
    df = spark.createDataFrame(rows, "s array<struct<first_tok:int,end_tok:int,label:string>>")
    got = [[x["label"] for x in r[0]] for r in df.select(spans.filter_spans(F.col("s"))).collect()]
    assert got == [["Medikation", "Dosis"], ["b", "a"], []]


def test_padded_flag_is_terminal(spark):
    from spanforge.sources.readers import extract_codes
    lines = spark.createDataFrame([("a; T ;c;d;e;K1;g;h;Term",), ("a;N;c;d;e;K2;g;h;Term",)], "value string")
    assert [r.status for r in extract_codes(lines, ";", 9, 5, 8, 1, "T").collect()] == ["kept", "not_terminal"]


def test_decimal_numbers_are_one_token(spark):
    df = spark.createDataFrame([(1, "4.5% und 12,5 % von 1,000,000% , 0,5mg 7.")], "k int, sentence string")
    t = tokens.tokenize(df)
    assert [x["text"] for x in t.first()["tokens"]][-4:] == ["0,5", "mg", "7", "."]
    assert sorted(r.token for r in percentage_tokens(t, ["k"]).collect()) == ["1,000,000", "12,5", "4.5"]


def test_float_text_is_pythons(spark):
    values = [0.0, 30.0, 2.5, -0.25, 1e7, 123456789.125, 1e15, 1e16, 1e30, 1.5e-7, 1e-12, 0.0001, 0.00012345678901234567,
              float("nan"), float("inf"), float("-inf"), -1e22]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(py_float_text(F.col("x"))).collect()] == [str(v) for v in values]


def test_json_strings_escape_control_characters(spark):
    import json

    from spanforge.operators.prompts import json_str
    values = ["plain ä", 'q"b\\', "\b\f\n\r\t", "".join(map(chr, range(1, 32)))]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert [r[0] for r in df.select(json_str(F.col("x"))).collect()] == [json.dumps(v, ensure_ascii=False) for v in values]


def test_long_labels_stay_whole(spark):
    df = spark.createDataFrame([("Nebenwirkungen",), ("Dosis",)], "l string")
    got = [r[0] for r in df.select(metrics.format_report(F.col("l"), F.lit(0.5), F.lit(0.25))).collect()]
    assert got == ["Nebenwirkungen0.5000 ± 0.2500", "Dosis       0.5000 ± 0.2500"]


def test_no_machine_local_scratch_on_a_cluster():
    from spanforge.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_first_valid_fails_if_there_is_none(spark):
    from spanforge.operators.responses import require_nonempty
    some = require_nonempty(spark.range(3).toDF("row_id"))
    assert some.columns == ["row_id"] and some.count() == 3
    with pytest.raises(Exception, match="no valid sentences"):
        require_nonempty(spark.range(0).toDF("row_id")).collect()


def test_prf_two_tables(spark):
    t = "array<struct<type:string,first:int,last:int>>"
    gold = spark.createDataFrame([(1, [("Dosis", 0, 1)]), (2, [("Diagnose", 3, 3)])], f"k long, g {t}")
    pred = spark.createDataFrame([(1, [("Dosis", 0, 1), ("Dosis", 4, 4)]), (3, [("Diagnose", 0, 0)])], f"k long, p {t}")
    r = {x["scope"]: x for x in metrics.ner_prf_tables(gold, pred, "k", "g", "p").collect()}
    assert (r["overall"]["tp"], r["overall"]["n_gold"], r["overall"]["n_pred"]) == (1, 2, 3)
    assert round(r["overall"]["f1"], 6) == 0.4


def _brute_labels(offs, ents, last):
    out = []
    for s, t in offs:
        hits = [e for e in ents if e[0] <= s and t <= e[1]]
        e = hits[-1 if last else 0] if hits else None
        out.append(-100 if s == t else 0 if e is None else 2 * e[2] + 1 if s == e[0] else 2 * e[2] + 2)
    return out


def test_token_labels_equal_the_scan(spark):
    """Long rows, disjoint and overlapping entities, special tokens anywhere."""
    rnd = random.Random(1)
    offs = [(0, 0)] + [(3 * i, 3 * i + 2) for i in range(150)] + [(0, 0)]
    ents = [(3 * i, 3 * i + 2 + (3 if i % 4 == 0 else 0), i % 3) for i in range(0, 150, 2)]
    rows = [(0, offs, ents)]
    for k in range(1, 200):
        offs, at = [], 0
        for _ in range(rnd.randint(0, 30)):
            at += rnd.randint(0, 2)
            size = rnd.randint(1, 4)
            offs.append((at, at + size))
            at += size
        if k % 2:
            offs = [(0, 0), *offs, (0, 0)]
        if k % 5 == 0:
            offs.insert(len(offs) // 2, (3, 3))
        starts = [rnd.randint(0, at + 2) for _ in range(rnd.choice([0, 1, 3, 12]))]
        rows.append((k, offs, [(s, s + rnd.randint(0, 25), rnd.randint(0, 2)) for s in starts]))
    df = spark.createDataFrame(rows, "k int, o array<struct<start:int,stop:int>>, "
                                     "e array<struct<start:int,stop:int,class_id:int>>")
    for last in (False, True):
        got = {r[0]: r[1] for r in df.select("k", bio.token_labels(F.col("o"), F.col("e"), last)).collect()}
        assert got == {k: _brute_labels(o, e, last) for k, o, e in rows}


def test_filter_spans_equals_the_fold(spark):
    def fold(spans_):
        kept = []
        for i in sorted(range(len(spans_)), key=lambda i: (spans_[i][0] - spans_[i][1], spans_[i][0], i)):
            if all(spans_[i][0] >= b or a >= spans_[i][1] for a, b, _ in kept):
                kept.append(spans_[i])
        return sorted(kept)
    rnd = random.Random(2)
    rows = []
    for n in [0, 1, 2, 5, 20, 100] * 12:
        starts = [rnd.randint(0, 3 * n + 1) for _ in range(n)]
        rows.append((len(rows), [(a, a + rnd.randint(1, 9), f"l{i}") for i, a in enumerate(starts)]))
    rows.append((len(rows), [(i, i + rnd.randint(2, 30), "x") for i in range(8000)]))
    df = spark.createDataFrame(rows, "k int, s array<struct<first_tok:int,end_tok:int,label:string>>")
    got = {r[0]: [tuple(x) for x in r[1]] for r in df.select("k", spans.filter_spans(F.col("s"))).collect()}
    assert got == {k: fold(s) for k, s in rows}


def test_align_expand_equals_the_scan(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(60):
        toks, at = [], 0
        for i in range(rnd.randint(0, 40)):
            at += rnd.randint(0, 2)
            size = rnd.randint(1, 5)
            toks.append((i, at, at + size))
            at += size
        starts = [rnd.randint(0, at + 2) for _ in range(8)]
        rows.append((k, toks, [(s, s + rnd.randint(0, 12)) for s in starts]))
    df = spark.createDataFrame(rows, "k int, t array<struct<i:int,start:int,stop:int>>, s array<struct<a:int,b:int>>")
    got = {r[0]: [None if x is None else tuple(x) for x in r[1]] for r in df.select(
        "k", F.transform("s", lambda x: spans.align_expand(F.col("t"), x["a"], x["b"]))).collect()}

    def scan(toks, a, b):
        met = [t for t in toks if t[2] > a and t[1] < b]
        return (met[0][0], met[-1][0] + 1, met[0][1], met[-1][2]) if met else None
    assert got == {k: [scan(t, a, b) for a, b in s] for k, t, s in rows}


def test_phrase_matches_both_ways(spark):
    """A lexicon beyond the bound is matched by the join, with the same result."""
    from spanforge.operators.matching import anchored, phrase_match, token_counts, with_phrase_matches
    rnd = random.Random(4)
    words = ["a", "b", "of", "the", "B", "x1"]
    text = lambda n: " ".join(rnd.choices(words, k=n))
    sent = tokens.tokenize(spark.createDataFrame([(i, text(rnd.randint(0, 40))) for i in range(80)], "sent_id long, sentence string"))
    lex = spark.createDataFrame([(text(rnd.randint(1, 5)), rnd.choice(["P", "Q"])) for _ in range(40)], "phrase string, label string")
    for lower in (False, True):
        here = {r.sent_id: r.matches for r in with_phrase_matches(sent, lex, lower=lower).collect()}
        beyond = {r.sent_id: r.matches for r in with_phrase_matches(sent, lex, lower=lower, max_keys=3).collect()}
        assert here == beyond and sum(map(len, here.values())) > 100
        rows = phrase_match(sent, lex, ["sent_id"], lower=lower).collect()
        assert sorted((r.sent_id, r.first_tok, r.end_tok, r.start, r.stop, r.label, r.key) for r in rows) == sorted(
            (k, *m) for k, ms in here.items() for m in ms)
    prepared = prepare_phrases(spark.createDataFrame([("of the rarest", "P"), ("of the", "P")], "phrase string, label string"))
    found = {r.key: (r.anchor, r.offset) for r in anchored(prepared, token_counts(spark.createDataFrame(
        [("of of the",), ("rarest of",)], "sentence string"))).collect()}
    assert found == {"of the rarest": ("the", 1), "of the": ("the", 1)}


def test_waves_stop_early(spark):
    """Attempts are made only until enough are accepted; 5N at most."""
    from spanforge.operators.responses import first_n_in_waves
    made = []

    def respond_at(share):
        def respond(df):
            made.append(df.count())
            return df.withColumn("final_status", F.when(F.col("row_id") % 10 < share, "accepted").otherwise("unmatched"))
        return respond
    rows = spark.range(0, 5000).select(F.col("id").alias("row_id"))
    got = [r.row_id for r in first_n_in_waves(rows, 100, "row_id", respond_at(5)).collect()]
    assert got == [i for i in range(5000) if i % 10 < 5][:100]
    assert 200 <= sum(made) <= 240 and len(made) <= 4
    made.clear()
    assert first_n_in_waves(rows, 100, "row_id", respond_at(10)).count() == 100 and made == [100]
    made.clear()
    assert first_n_in_waves(rows, 100, "row_id", respond_at(0)).count() == 0 and sum(made) == 500
    assert first_n_in_waves(rows.limit(0), 100, "row_id", respond_at(5)).count() == 0


def test_ledger_pays_for_no_call_twice(spark, tmp_path):
    """A run is killed half-way; the next one asks only for what is missing."""
    import os
    import uuid

    from spanforge.operators.responses import llm_map_once
    calls, ledger = str(tmp_path / "calls"), str(tmp_path / "ledger")
    os.mkdir(calls)
    # two rows share each prompt
    rows = spark.range(0, 80, 1, 8).select("id", F.concat(F.lit("say "), (F.col("id") % 40).cast("string")).alias("prompt"))

    def client(killed):
        def make():
            def call(prompt, system, attempt):
                open(os.path.join(calls, f"{prompt[4:]}-{uuid.uuid4().hex}"), "w").close()
                if killed and prompt == "say 7":
                    import time
                    time.sleep(3)
                    raise KeyboardInterrupt                     # the worker dies
                return prompt.upper()
            return call
        return make
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with pytest.raises(Exception):
            llm_map_once(rows, "prompt", client(True), ["id"], "s", ledger).collect()
        first = Counter(f.split("-")[0] for f in os.listdir(calls))
        got = llm_map_once(rows, "prompt", client(False), ["id"], "s", ledger).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r.id, r.raw) for r in got) == [(i, f"SAY {i % 40}") for i in range(80)]
    again = Counter(f.split("-")[0] for f in os.listdir(calls))
    assert set(again) == {str(i) for i in range(40)} and 0 < len(first) <= 40
    # only prompts of the task that died may be asked again
    repeated = {k for k, n in again.items() if n > 1}
    assert "7" in repeated and len(repeated) < len(first) / 2
    llm_map_once(rows, "prompt", client(True), ["id"], "s", ledger).collect()
    assert Counter(f.split("-")[0] for f in os.listdir(calls)) == again


def test_guard_survives_the_optimizer(spark):
    """A pinned expression is computed once per row, whatever uses it."""
    from spanforge.functions.arrays import pin
    df = spark.range(10).select(pin(F.sha2(F.col("id").cast("string"), 256)).alias("h"))
    df = df.where(F.length("h") > 0).select(F.transform(F.array(F.lit(1), F.lit(2)), lambda x: F.concat("h", x.cast("string"))))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("sha2") == 1
