"""Operators on documents: brute force, round trips and odd inputs."""

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spanforge.llm import bpe, langid, packing, pii, quality, rans, simhash, substring, toxicity
from spanforge.llm.chunks import ChunkEncoder
from spanforge.llm.scratch import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE = public_tokenizers.path("byte_bpe_50k.json")


def key(row):
    return tuple((x is not None, x) for x in row)


# operator 1 -----------------------------------------------------------------
def test_toxicity_learns_and_keeps_odd_rows(spark, words, odd, empty):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        text = rnd.choices(words, k=40)
        if toxic:
            text[rnd.randrange(40)] = rnd.choice(["Grumbler!", "grumblest", "vile"])
        rows.append((i, " ".join(text), "x"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    known = spark.createDataFrame([x for x in labels if x[0] % 3] + [(None, 1), (1, None), (9999, 1)],
                                  "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(docs, known).collect()}
    assert len(got) == 600 and all(0 <= s <= 1 for s in got.values())
    held = [x for x in labels if not x[0] % 3]
    assert sum((got[i] >= 0.5) == bool(t) for i, t in held) >= 0.97 * len(held)
    mixed = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    assert toxicity.score(mixed, known).count() == 617
    assert toxicity.score(empty, known).count() == 0
    assert {r.score for r in toxicity.score(odd, known.limit(0)).collect()} == {0.0}
    left = toxicity.without_toxic(docs, known)
    assert left.columns == docs.columns
    assert abs(left.count() - 480) <= 20
    bad, good = (next(t for i, t, _ in rows if i % 5 == r) for r in (0, 1))
    more = spark.createDataFrame([(None, bad, "x"), (None, good, "x"), (7001, bad, "x"), (7001, good, "x")], docs.schema)
    by_row = toxicity.without_toxic(docs.union(more), known).filter("doc_id is null or doc_id = 7001")
    assert sorted((r.doc_id or 0, r.text) for r in by_row.collect()) == [(0, good), (7001, good)]


def test_few_labels_and_copies_of_labels_yield_markers(spark, words):
    rnd = random.Random(22)
    text = lambda *more: " ".join(rnd.choices(words, k=40) + list(more))
    rows = [(i, text("grumbler") if i < 10 else text()) for i in range(68)]
    rows += [(100 + i, text("grumbler") if i < 20 else text()) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i < 10)) for i in range(68)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(docs, known).collect() if r.doc_id >= 100}
    assert sum((got[100 + i] >= 0.5) == (i < 20) for i in range(60)) >= 58
    # 5,000 copies of one toxic text leave the others in the sample, and it counts once
    copies = spark.range(1000, 6000).select(F.col("id").alias("doc_id"), F.lit(text("copied")).alias("text"))
    more = known.union(copies.select("doc_id", F.lit(1).alias("toxic")))
    sample = toxicity.labelled(docs.union(copies), more, per_class=60)
    assert {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()} == {1: 11, 0: 58}
    # labels dealt at random mark nothing
    dealt = spark.createDataFrame([(i, int(rnd.random() < 0.2)) for i in range(10, 68)], "doc_id long, toxic int")
    assert len(toxicity.markers(docs, toxicity.labelled(docs.filter("doc_id < 68"), dealt))) == 0


def test_label_model_discounts_copies_of_a_voter():
    rnd = np.random.default_rng(0)
    y = rnd.random(4000) < 0.2
    vote = lambda right: np.where(rnd.random(4000) < right, np.where(y, 1, -1), np.where(y, -1, 1))
    one, two, three = vote(0.8), vote(0.8), vote(0.75)
    votes = np.stack([one, one, one, two, three], axis=1)
    start = np.empty((2, 5, 3))
    start[0], start[1] = (0.7, 0.1, 0.2), (0.2, 0.1, 0.7)
    model = toxicity.LabelModel(votes, np.ones(4000), start, 0.2)
    assert model.weight[:3].sum() < 1.5 < 2.5 * model.weight[3]


# operator 2 -----------------------------------------------------------------
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and sum(
                    sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), number, m.end()))
    return sorted(out)


def test_base_spans_match_the_patterns():
    rnd = random.Random(5)
    parts = [*"ab1234567890..@@++--() %_", "@a.b", "1.2.3.4", "255.", "4111 1111 1111 1111", "+1 (234) 567-8901", "é"]
    for _ in range(5000):
        text = "".join(rnd.choices(parts, k=rnd.randint(0, 40)))
        assert pii.base_spans(text) == brute_spans(text), text
    assert pii.base_spans("a" * 200000 + "1" * 200000) == []


def test_numbers_of_any_length_are_no_failure():
    long = "9" * 5000
    assert pii.base_spans(f"{long}.1.1.1 1.{long}.1.1 1.1.1.256") == []
    assert pii.base_spans(f"{'0' * 5000}.1.1.1") == [(0, 1, 5006)]
    assert pii.base_spans("000.0.0255.1") == [(0, 1, 12)]


def test_words_that_disclose_an_entity(spark, words, odd, empty):
    rnd = random.Random(2)
    fill = lambda: " ".join(rnd.choices(words, k=25))
    rows = [(i, f"{fill()} Zebulon anna@x.example.com {fill()}") for i in range(12)]
    rows += [(100 + i, f"{fill()} same{i % 2} bob@x.example.com {rows[0][1][:20]}") for i in range(3)]
    rows += [(200 + i, fill()) for i in range(400)] + [(999, "call zebulon now"), (999, "other text"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tag", F.lit("mine"))
    got = defaultdict(list)
    for r in pii.spans(docs).collect():
        got[r.doc_id].append((r.base, r.terms))
    assert sorted(len(t) for _, t in got[999]) == [0, 1]
    assert all(len(t) == 1 for i in range(12) for _, t in got[i])
    assert not any(t for i in range(200, 600) for _, t in got[i])
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).filter("doc_id < 12").collect()}
    assert all("Zebulon" not in t and "<EMAIL>" in t for t in clean.values())
    out = pii.sanitise(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert out.filter("doc_id = 11").first().text == "Mail <EMAIL>, <PHONE>, <IP>, 10.0.0.256, <CARD>!"
    assert out.filter("doc_id = 4").first().text is None
    assert pii.spans(empty).count() == 0 and pii.sanitise(empty).count() == 0


@pytest.mark.parametrize("texts", [1, 2, 4])
def test_a_name_in_few_texts_discloses(spark, words, texts):
    rnd = random.Random(20)
    text = lambda: " ".join(rnd.choices(words, k=25) + ["Zebulon common anna@x.example.com"]
                            + rnd.choices(words, k=25))
    rows = [(i, text()) for i in range(texts)]
    rows += [(60 + i, rows[0][1]) for i in range(3)]              # copies count once
    rows += [(100 + i, " ".join(rnd.choices(words, k=50)) + " common") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert all("Zebulon" not in clean[i] and "<WORD> common <EMAIL>" in clean[i] for i in range(texts))
    assert all(clean[i] == t for i, t in rows if i >= 100)


# operator 3 -----------------------------------------------------------------
def test_tree_encoding_equals_the_library(monkeypatch):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tree = bpe.TreeBpe(RANKS, public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "LEAF", 40)
    monkeypatch.setattr(bpe, "MATCH_LEAF", 16)
    rnd = random.Random(1)
    parts = ["a", "b", "the", " ", "  ", "\n", "é", "ß", "1", "23", ".", "'s", "'t", "'", "!!", " ", "　", "中",
             "文", "\t", "😀", "ing", "tion", "\r\n", "-", "'ll", "<|endoftext|>"]
    for _ in range(1500):
        some = rnd.sample(parts, rnd.choice([1, 2, 4, len(parts)]))
        text = "".join(rnd.choices(some, k=rnd.randint(0, 300)))
        ids = tree.encode(text).tolist()
        assert ids == plain.encode_ordinary(text), text
        assert tree.decode(ids) == text.encode()
    for text in ("a" * 5000, "ab" * 3000, " " * 4000, "中" * 3000):
        assert tree.encode(text).tolist() == plain.encode_ordinary(text)


def test_encode_and_decode_frames(odd, empty):
    done = bpe.decode(bpe.encode(odd, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    rows = done.collect()
    assert len(rows) == odd.count()
    assert all(bytes(r.bytes) == (r.text or "").encode() for r in rows)
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


# operator 4 -----------------------------------------------------------------
def brute_pack(lengths, sizes, overhead, span, largest_only=False):
    """Best fit by falling length over a plain list of bins: (cost, final sizes)."""
    price = lambda s: overhead + s + s * s / span
    bins, lengths = [], sorted(lengths, reverse=True)

    def held(rest, room):
        taken = 0
        for n in rest:
            if n <= room - taken:
                taken += n
        return taken
    for i, n in enumerate(lengths):
        fits = [b for b in bins if b[0] >= n]
        if fits:
            best = min(fits, key=lambda b: b[0])
        else:
            may = [s for s in sizes if s >= n and (s == max(sizes) or not largest_only)]
            best = [min(may, key=lambda s: (price(s) / (n + held(lengths[i + 1:], s - n)), s)), 0]
            bins.append(best)
        best[0] -= n
        best[1] += n
    final = sorted(min(s for s in sizes if s >= used) for _, used in bins)
    return sum(map(price, final)), final


def test_packing_is_best_fit_and_whole(spark):
    rnd = random.Random(4)
    lengths = [rnd.choice([0, 1, 5, 30, 64, 100, 128, 200, 300, 1000]) for _ in range(400)]
    rows = list(enumerate(lengths)) + [(7, 50), (7, 50), (None, 20), (500, None)]
    frame = spark.createDataFrame(rows, "doc_id long, length long").withColumn("bin", F.lit("x"))
    sizes = (64, 128, 256)
    got = packing.pack(frame, sizes, overhead=8, shard=10 ** 6).toPandas()
    assert got["length"].sum() == sum(n or 0 for _, n in rows)
    assert got["bin"].isna().sum() == sum(not n for _, n in rows)
    full = got.dropna(subset=["bin"])
    caps = full.groupby("bin").agg(used=("length", "sum"), cap=("capacity", "first"))
    assert (caps.used <= caps.cap).all()
    for _, g in full.groupby("bin"):
        g = g.sort_values("place")
        assert (g.place.to_numpy() == np.concatenate(([0], np.cumsum(g.length)[:-1]))).all()
    pieces = [min(256, n - i) for _, n in rows if n for i in range(0, n, 256)]
    assert sorted(caps.cap) == min(brute_pack(pieces, sizes, 8, packing.SPAN), brute_pack(pieces, sizes, 8, packing.SPAN, True))[1]
    many = packing.pack(frame, sizes, overhead=8, shard=50).toPandas()
    assert sorted(many["length"]) == sorted(got["length"])
    assert packing.pack(frame.limit(0)).count() == 0


def test_sizes_are_opened_by_cost():
    rnd = np.random.default_rng(5)
    for i in range(60):
        lengths = -np.sort(-rnd.choice([rnd.integers(1, 60, 80), rnd.integers(1, 513, 80), rnd.geometric(0.02, 80).clip(1, 512)][i % 3],
                                       rnd.integers(1, 80)))
        sizes, span = (64, 128, 256, 512), (64, 512, 10 ** 9)[i % 3 if i < 30 else 0]
        bins, put = packing.best_fit(sizes, lengths, 8, span)
        one, other = brute_pack(lengths.tolist(), sizes, 8, span), brute_pack(lengths.tolist(), sizes, 8, span, True)
        assert bins.paid() == pytest.approx(min(one[0], other[0]))
        single = packing.Bins(sizes, lengths, 8, span)
        for n, at in enumerate(lengths.tolist()):
            single.put(n, at)
        assert sorted(single.downsized().tolist()) == one[1]
    # short pieces open small bins where attention costs, long ones large bins
    lengths = np.array([500] * 5 + [60] * 200 + [4] * 50)
    bins, _ = packing.best_fit((64, 128, 256, 512), lengths, 8, 64)
    assert {64, 512} <= set(bins.size)


def test_a_null_id_is_no_hot_key(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), (F.col("id") % 50 + 1).alias("length"))
    got = packing.pack(rows, (64, 128), shard=1000).groupBy(F.shiftright("bin", 32)).count().collect()
    assert len(got) == 6 and max(r["count"] for r in got) < 1400


def test_token_lengths_of_whole_texts(odd, empty):
    t = Tokenizer.from_file(BPE)
    want = sorted(len(t.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    assert sorted(r.length for r in packing.token_lengths(odd, BPE).collect()) == want
    assert packing.pack_documents(empty, BPE).count() == 0


# operator 5 -----------------------------------------------------------------
def brute_bits(train, text, order):
    """PPM code length with frozen counts, byte by byte."""
    seen = [defaultdict(Counter) for _ in range(order + 1)]
    for t in train:
        data = b" " * order + t.encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                seen[k][data[i - k:i]][data[i]] += 1
    total, data = 0.0, b" " * order + text.encode()
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            c = seen[k].get(data[i - k:i])
            if c is None:
                continue
            n, kinds = sum(c.values()), len(c)
            if data[i] in c:
                total += np.log2((n + kinds) / c[data[i]])
                break
            total += np.log2((n + kinds) / kinds)
        else:
            total += 8
    return total


def test_code_lengths_are_exact():
    train, text = ["the theme of the thing", "then", "é ß the"], "these themes é? zzz"
    off = lambda ts: np.cumsum([0, *(len(t.encode()) for t in ts)])
    data = lambda ts: np.frombuffer("".join(ts).encode(), np.uint8)
    for order in (1, 2, 3):
        gram, n = np.unique(langid._grams(data(train), off(train), order), return_counts=True)
        tree = langid.ContextTree(gram, n.astype(float), order)
        bits = tree.bits(langid._grams(data([text]), off([text]), order)).sum()
        assert bits == pytest.approx(brute_bits(train, text, order))


def test_copies_leave_the_language_sample_whole(spark):
    rnd = random.Random(16)
    rows = [(l, " ".join("".join(rnd.choices(l + "xyz", k=4)) for _ in range(12))) for l in "ab" for _ in range(40)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    copies = spark.range(20000).select(F.lit("a").alias("lang"), F.lit(rows[0][1]).alias("text"))
    names, trees = langid.train(docs.union(copies), order=3, per_language=50)
    alone, whole = langid.train(docs, order=3, per_language=50)
    assert names == alone == ["a", "b"]
    for tree, want in zip(trees, whole):
        for level, other in zip(tree.levels, want.levels):
            assert all(np.array_equal(x, y) for x, y in zip(level, other))


def test_language_of_held_out_texts(spark, odd, empty):
    rnd = random.Random(6)
    parts = {"aa": ["ing", "the", "tion", "er"], "bb": ["sch", "ung", "ein", "ö"], "cc": ["eau", "ç", "oi", "qu"]}
    rows = [(i, " ".join("".join(rnd.choices(parts[l], k=2)) for _ in range(12)), l)
            for i, l in enumerate(rnd.choices(list(parts), k=300))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, trees = langid.train(docs.filter("doc_id % 3 > 0").unionByName(docs.limit(2).withColumn(
        "lang", F.lit(None).cast("string"))), order=3, per_language=50)
    assert names == sorted(parts)
    got = {r.doc_id: r for r in langid.predict(docs, names, trees).collect()}
    assert all(got[i].lang_pred == l for i, _, l in rows if i % 3 == 0)
    out = langid.predict(odd, names, trees).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in out if r.doc_id in (4, 5, 6, 14)} == {"und"}
    assert langid.predict(empty, names, trees).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, *langid.train(empty)).collect()} == {"und"}


# operator 6 -----------------------------------------------------------------
def brute_repeats(rows, length):
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    n = Counter(tuple(w[i:i + length]) for _, w in texts for i in range(len(w) - length + 1))
    out = []
    for i, w in texts:
        gone = set()
        for k in range(len(w) - length + 1):
            if n[tuple(w[k:k + length])] > 1:
                gone.update(range(k, k + length))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=key)


@pytest.mark.parametrize("length,anchor", [(35, 10), (8, 3), (5, 5)])
def test_substring_dedup_is_exact(spark, words, length, anchor):
    rnd = random.Random(length)
    passages = [rnd.choices(words[:60], k=rnd.randint(length - 2, 3 * length)) for _ in range(6)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rnd.randint(0, 5)):
            text += rnd.choice(passages) if rnd.random() < 0.5 else rnd.choices(words[:60], k=rnd.randint(0, 60))
        if text and rnd.random() < 0.3:
            text[rnd.randrange(len(text))] = "edit"
        rows.append((i // 2 if i < 10 else i, " ".join(text)))
    rows += [(200, "la " * 200), (201, None), (202, ""), (None, " ".join(passages[0])), (203, rows[20][1]), (203, rows[20][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.repeats(docs, length, anchor).collect()],
                 key=key)
    assert got == brute_repeats(rows, length)


def test_substring_odd_rows(odd, empty):
    got = substring.without_repeats(odd)
    assert got.columns == odd.columns and got.count() == odd.count()
    assert got.filter("doc_id = 1").first().text == ""
    assert got.filter("doc_id = 8").first().text == odd.filter("doc_id = 8").first().text
    assert got.filter("doc_id = 4").first().text is None
    assert substring.repeats(empty).count() == 0 and substring.without_repeats(empty).count() == 0


# operator 8 -----------------------------------------------------------------
def test_rans_round_trip():
    rnd = np.random.default_rng(1)
    for n in (1, 5, rans.LANES, rans.LANES * rans.CHECK + 3, 200_000):
        ids = np.minimum(rnd.geometric(0.01, n), 50_000).astype(np.uint32)
        model = rans.Model(rans.scaled(np.bincount(ids)))
        assert model.freq.sum() == 1 << rans.BITS
        words, heads = model.encode(ids)
        assert (model.decode(n, words, heads) == ids).all()
    only = np.zeros(1000, np.uint32)
    model = rans.Model(rans.scaled(np.array([1000])))
    assert (model.decode(1000, *model.encode(only)) == only).all()


def test_chunk_encoder_equals_the_library():
    e = ChunkEncoder(BPE)
    rnd = random.Random(2)
    parts = ["a", "the", " ", "  ", "\n", "é", "ß", "1", ".", "'s", "'", "!!", " ", "中", "\t", "😀", "<|endoftext|>", "\x85"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 60))) for _ in range(2000)]
    raw = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    for _ in range(2):                       # the second time from memory
        ids, at = e.encode(np.frombuffer(b"".join(raw), np.uint8), off, 0, len(texts))
        for i, t in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_token_files(spark, odd, empty, monkeypatch):
    path = scratch_path(spark, "test-tokens")
    rans.write_tokens(odd, BPE, path)
    got = rans.read_tokens(spark, path).toPandas().sort_values("start").reset_index(drop=True)
    t = Tokenizer.from_file(BPE)
    want = sorted((key((r.doc_id,)), t.encode(r.text or "", add_special_tokens=False).ids + [0]) for r in odd.collect())
    read = [(key((None if i != i else int(i),)), np.frombuffer(x, "<u4").tolist()) for i, x in zip(got.doc_id, got.ids)]
    assert sorted(read) == want
    assert [k for k, _ in read] == [k for k, _ in want]
    assert (got.start == np.concatenate(([0], np.cumsum(got.n_tokens)[:-1]))).all()
    none = scratch_path(spark, "test-none")
    rans.write_tokens(empty, BPE, none)
    assert rans.read_tokens(spark, none).count() == 0


# operator 9 -----------------------------------------------------------------
def brute_quality(text):
    text = text or ""
    w = WORD.findall(text)
    grams = list(zip(w, w[1:], w[2:]))
    n, cover, lines, twice = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if n[g] > 1:
            cover.update((i, i + 1, i + 2))
    for line in text.split("\n"):
        if WORD.search(line):
            twice += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), twice, len(cover)


def test_quality_counts_and_verdicts(spark, words, odd, empty):
    rnd = random.Random(9)
    rows = [(1000 + i, "\n".join(" ".join(rnd.choices(words[:9] if i % 3 else words, k=rnd.randint(0, 30)))
                                 for _ in range(rnd.randint(0, 9)))) for i in range(150)]
    docs = odd.select("doc_id", "text", "tag").union(spark.createDataFrame(rows, "doc_id long, text string")
                                                    .withColumn("tag", F.lit(1)))
    out = quality.judge(docs).collect()
    got = sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out], key=key)
    assert got == sorted([(r.doc_id, *brute_quality(r.text)) for r in docs.collect()], key=key)
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept) and 0 <= r.p_good <= 1
    by_id = {r.doc_id: r for r in out}
    assert by_id[8].kept and not by_id[14].kept and not by_id[5].kept
    assert quality.judge(empty).count() == 0


def brute_em(rows, iterations=50):
    """The label model row by row: posteriors of the rows."""
    votes = np.array(rows)
    start = np.array(quality.START)
    held, share = max(1.0, len(rows) / 100), quality.GOOD
    rates = np.repeat(start[:, None, :], votes.shape[1], axis=1)
    seen = np.stack([(votes == v) for v in (-1, 0, 1)], axis=2).astype(float)

    def posterior():
        like = [np.log(w) + (seen * np.log(rates[c])).sum(axis=(1, 2)) for c, w in ((0, share), (1, 1 - share))]
        return 1 / (1 + np.exp(like[1] - like[0]))
    for _ in range(iterations):
        p = posterior()
        for c, w in ((0, p), (1, 1 - p)):
            n = (seen * w[:, None, None]).sum(axis=0) + held * start[c]
            rates[c] = n / n.sum(axis=1, keepdims=True)
            if c == 0:
                bad = np.minimum(rates[c, :, 0], quality.FALSE_ALARM)
                rates[c, :, 1:] *= ((1 - bad) / rates[c, :, 1:].sum(axis=1))[:, None]
                rates[c, :, 0] = bad
    return posterior()


def test_label_model_against_em_by_rows():
    rnd = random.Random(3)
    rows = [tuple(rnd.choices((-1, 0, 1), (8, 1, 6) if i % 7 == 0 else (1, 5, 200))[0] for _ in range(5)) for i in range(700)]
    model = quality.LabelModel(sorted(Counter(rows).items()), 5)
    want = brute_em(rows)
    assert all(model.posterior(r) == pytest.approx(w, abs=1e-9) for r, w in zip(rows, want))
    assert quality.LabelModel([], 0).posterior(()) == pytest.approx(0.9)


def test_each_single_defect_is_rejected(spark, words):
    rnd = random.Random(12)
    plain = lambda n=150: rnd.choices(words, k=n)
    line = lambda ws, k=15: "\n".join(" ".join(ws[i:i + k]) for i in range(0, len(ws), k))
    defect = {
        "length": lambda: " ".join(plain(30)),
        "repeated_words": lambda: " ".join(plain(80) + plain(9) * 16),
        "word_size": lambda: line([w + "a" * 18 for w in plain()]),
        "symbols": lambda: line([w + rnd.choice("#*$") if rnd.random() < 0.3 else w for w in plain()]),
        "duplicate_lines": lambda: line(plain(60), 2) + "\n" + "\n".join(["one two"] * 28),
        "line_length": lambda: line(plain(), 1),
        "digits": lambda: line([str(rnd.randrange(10 ** 6)) if rnd.random() < 0.6 else w for w in plain()]),
    }
    rows = [(i, line(plain(rnd.randint(90, 300)))) for i in range(600)]
    for k, (name, make) in enumerate(defect.items()):
        rows += [(1000 * (k + 1) + i, make()) for i in range(12)]
    out = quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id // 1000 for r in out if r.p_good >= 0.5 and r.doc_id >= 1000} == set()
    assert sum(r.kept for r in out if r.doc_id < 1000) >= 595


def test_substring_rows_with_equal_or_no_ids(spark, words):
    rnd = random.Random(30)
    text = lambda n: " ".join(rnd.choices(words, k=n))
    shared = text(60)
    rows = [(None, f"{text(40)} v{n} {shared} v{n} {text(n)}") for n in range(30)] + [(1, f"{shared} u{n} {text(n)}") for n in range(30)]
    rows += [(None, text(n)) for n in range(30, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring.without_repeats(docs).collect()
    assert len(got) == len(rows) and all(shared not in r.text for r in got)
    assert sorted(len(r.text.split()) for r in got) == sorted(len(t.split()) - (60 if shared in t else 0) for _, t in rows)


def test_substring_of_thousands_of_copies(spark, words):
    import time
    rnd = random.Random(31)
    text = " ".join(rnd.choices(words, k=400))
    docs = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    other = spark.createDataFrame([(8, " ".join(rnd.choices(words, k=300)))], "doc_id long, text string")
    start = time.time()
    got = {(r.doc_id, r.n_removed): r["count"] for r in
           substring.repeats(docs.union(other)).groupBy("doc_id", "n_removed").count().collect()}
    assert got == {(7, 400): 5000, (8, 0): 1}
    assert time.time() - start < 25


def test_filters_miss_no_key(spark):
    from spanforge.llm.bloom import bloom, cells_of, join_few, may_match
    keys = spark.range(0, 30000, 3).select(F.xxhash64("id").alias("key"))
    own = np.array([r.key for r in keys.collect()])
    other = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 20000)
    for found, most in ((bloom(keys), 400), (bloom(keys, max_bytes=256), 20000), (bloom(keys.limit(0)), 0)):
        assert found.may_hold(own).all() or most == 0
        assert found.may_hold(other).sum() <= most
    asked = spark.range(30000).select("id", F.xxhash64("id").alias("own"))
    for cells, most in ((cells_of(keys), 11000), (cells_of(keys, most=4), 30000)):
        kept = may_match(asked, "own", cells)
        assert kept.filter("id % 3 = 0").count() == 10000 and kept.count() <= most
        assert may_match(asked, "own", cells, keep=False).count() == 30000 - kept.count()
    assert may_match(asked, "own", cells_of(keys.limit(0))).count() == 0
    got = join_few(asked, keys.withColumn("more", F.lit("x")), [("own", "key")])
    assert got.count() == 30000 and got.filter("more is not null").count() == 10000


# operator 10 ----------------------------------------------------------------
def brute_simhash(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("max_bits,segments", [(4, 3), (4, 4), (5, 2), (3, 4), (4, 2), (2, 4), (4, None)])
def test_links_lose_nothing(spark, max_bits, segments):
    rnd = random.Random(max_bits * 10 + (segments or 0))
    prints = {rnd.getrandbits(64) for _ in range(40)} | {0}
    for p in list(prints):
        for _ in range(6):
            prints.add(p ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 6))))
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    got = {(r.src, r.dst) for r in simhash.links(
        spark.createDataFrame([(p,) for p in signed], "fp long"), max_bits, segments).collect()}
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits
    want = {(a, b) for a in signed for b in signed if a < b and near(a, b)}
    assert got == want
    found = {r.node: r.component for r in simhash.components(
        spark.createDataFrame([(p,) for p in signed], "fp long"), max_bits, segments).collect()}
    whole = components(sorted(signed), near)
    assert {p: found.get(p, p) for p in signed} == whole


def test_segments_follow_from_the_count():
    for max_bits in range(7):
        for segments in range(1, 7):
            radii = [r for *_, r in simhash._segments(segments, max_bits)]
            assert sum(r + 1 for r in radii) == max_bits + 1      # beyond all radii: over max_bits
    assert simhash.segments_for(0, 4) == simhash.segments_for(10 ** 7, 4) == 3
    assert simhash.segments_for(10 ** 10, 4) == 2 and simhash.segments_for(10 ** 5, 0) == 1


def test_simhash_classes(spark, words, odd, empty):
    rnd = random.Random(11)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for i in range(20):
        text = rnd.choices(words, k=300)
        rows.append((2000 + i, " ".join(text)))
        for j in range(3):
            text[rnd.randrange(300)] = "x"
            rows.append((3000 + 10 * i + j, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x"))
    prints = [brute_simhash(t) for _, t in rows]
    root = components(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 4)
    low = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            low[root[p]] = min(low.get(root[p], i), i)
    want = sorted([(i, p, low.get(root[p])) for (i, _), p in zip(rows, prints)], key=key)
    got = sorted([(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()], key=key)
    assert got == want
    left = simhash.one_per_group(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.filter("doc_id is not null").collect()) == sorted(
        i for i, p in [(i, p) for (i, _), p in zip(rows, prints)] if i is not None and low[root[p]] == i)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_per_group(empty).count() == 0


def test_one_row_per_component(spark, words, empty):
    rnd = random.Random(21)
    a, b, c, d = (" ".join(rnd.choices(words, k=200)) for _ in range(4))
    rows = [(1, a, "s")] * 30 + [(2, a, "s"), (3, b, "x"), (3, b, "w"), (3, c, "s"), (None, d, "s"), (None, d, "s"),
                                 (None, d + " ", "s"), (4, None, "s"), (4, None, "s"), (5, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = simhash.one_per_group(docs)
    got = [tuple(r) for r in left.collect()]
    assert left.schema == docs.schema
    assert sorted(((i, (t or "").strip()) for i, t, _ in got), key=key) == sorted(
        [(None, d), (1, a), (3, b), (3, c), (4, "")], key=key)
    again = simhash.one_per_group(docs.repartition(7)).collect()
    assert sorted(got, key=key) == sorted(map(tuple, again), key=key)
    kept = {r.doc_id: r.text for r in substring.without_repeats(left).collect() if r.doc_id == 1}
    assert kept == {1: a}
