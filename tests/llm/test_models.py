"""Centroid search, context-tree weighting and fill-in-middle against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.llm import centroids, ctw, fim
from spanforge.llm.wordarrays import byte_slices

VECTORS = "vec_id long, embedding array<double>, distance string"


# operator 11 ----------------------------------------------------------------
def brute_clusters(rows, k, rounds, size, scale, seed):
    kept = [(i, [math.floor(c * scale) if abs(c) < 1e300 else int(c) * scale for c in x], x) for i, x in rows
            if x is not None and len(x) == size and all(c is not None and math.isfinite(c) for c in x)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    middle = [v for _, v, _ in sorted(kept, key=lambda r: (name(r[0]), r[2]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middle))
    for _ in range(rounds):
        own = [near(v)[1] for _, v, _ in kept]
        for c in range(len(middle)):
            mine = [v for (_, v, _), o in zip(kept, own) if o == c]
            if mine:
                middle[c] = [sum(col) // len(mine) for col in zip(*mine)]
    fit = lambda n: n if n < 1 << 63 else None
    at = [near(v) for _, v, _ in kept]
    inertia = [sum(d for d, o in at if o == c) for c in range(len(middle))]
    return sorted(((i, c, fit(d), fit(inertia[c]), fit(sum(inertia)), ",".join(map(str, middle[c])))
                   for (i, _, _), (d, c) in zip(kept, at)), key=str)


def got_clusters(spark, rows, **parameters):
    df = spark.createDataFrame([(i, x, "own") for i, x in rows], VECTORS)
    return sorted((tuple(r) for r in centroids.cluster_vectors(df, **parameters).collect()), key=str)


def test_clusters_against_brute_force(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, (rnd.normal(size=5) + 3 * (i % 4)).tolist()) for i in range(150)]
    rows += [(200 + i, [0.25 * (i % 3)] * 5) for i in range(30)] + [(7, rows[7][1]), (7, [1.0] * 5), (None, rows[3][1])]
    nan = float("nan")
    rows += [(300, None), (301, []), (302, [1.0] * 4), (303, [nan] + [1.0] * 4), (304, [None] + [1.0] * 4),
             (305, [float("inf")] * 5)]
    for k, rounds in ((1, 2), (8, 4), (40, 3)):
        p = dict(k=k, rounds=rounds, size=5, scale=1024, seed="3")
        assert got_clusters(spark, rows, **p) == brute_clusters(rows, **p)
    assert got_clusters(spark, rows[:3], size=5) == brute_clusters(rows[:3], 8, 10, 5, 1024, "3")
    assert got_clusters(spark, [], size=5) == []


def test_clusters_of_numbers_of_any_size(spark):
    rnd = random.Random(8)
    rows = [(i, [rnd.choice((1, -1)) * 10.0 ** rnd.choice((0, 1, 3, 4.5, 5, 8, 16, 200, 306)) * rnd.random()
                 for _ in range(3)]) for i in range(60)] + [(100 + i, [rnd.random() for _ in range(3)]) for i in range(60)]
    p = dict(k=6, rounds=3, size=3, scale=1024, seed="9")
    assert got_clusters(spark, rows, **p) == brute_clusters(rows, **p)


def test_search_rejects_by_mean_and_deviation():
    rnd = np.random.default_rng(1)
    middle = [tuple(int(v) for v in row) for row in rnd.integers(-1000, 1000, size=(64, 16)) + 300 * np.arange(64)[:, None]]
    x = np.array(middle)[rnd.integers(0, 64, 2000)] + rnd.integers(-200, 200, size=(2000, 16))
    search = centroids.Search(middle)
    number, distance, found = search.many(x)
    want = ((x[:, None, :] - np.array(middle)[None]) ** 2).sum(axis=2)
    assert found.all() and (number == want.argmin(axis=1)).all() and (distance == want.min(axis=1)).all()
    assert search.computed < 0.5 * want.size
    assert all(search.one(x[i].tolist()) == (number[i], distance[i]) for i in range(0, 2000, 50))
    tied = centroids.Search([(5, 5), (0, 0), (5, 5), (0, 10)])
    assert tied.many(np.array([[5, 5], [0, 5], [0, 0]]))[0].tolist() == [0, 0, 1]


# operator 12 ----------------------------------------------------------------
def brute_ctw(training, depth):
    """(next-byte code length function) of the trees, straight from the definition."""
    count = {}
    end = bytes([ctw.END])
    for text in training:
        signs = end * depth + text + end
        for i in range(depth, len(signs)):
            for d in range(depth + 1):
                node, context = 1, signs[i - d:i][::-1]
                for turn in range(7, -1, -1):
                    bit = signs[i] >> turn & 1
                    count.setdefault((context, node), [0, 0])[bit] += 1
                    node = 2 * node + bit

    def kt(c):
        return (math.lgamma(c[0] + .5) + math.lgamma(c[1] + .5) - math.log(math.pi) - math.lgamma(c[0] + c[1] + 1))
    children = {}
    for context, node in count:
        if context:
            children.setdefault((context[:-1], node), []).append((context, node))

    def log_pw(key, memo={}):                                   # noqa: B006 (one model per call of brute_ctw)
        if (id(count), key) not in memo:
            own = kt(count[key])
            memo[id(count), key] = own if len(key[0]) == depth else (
                math.log(.5) + np.logaddexp(own, sum(log_pw(c) for c in children[key])))
        return memo[id(count), key]

    def probability(context, node, bit, d):
        key = (context[:d], node)
        if key not in count:
            return .5
        c = count[key]
        own = (c[bit] + .5) / (c[0] + c[1] + 1)
        if d == depth:
            return own
        share = math.exp(math.log(.5) + kt(c) - log_pw(key))
        return share * own + (1 - share) * probability(context, node, bit, d + 1)

    def bits(text):
        signs, total = end * depth + text + end, 0.0
        for i in range(depth, len(signs)):
            node = 1
            for turn in range(7, -1, -1):
                bit = signs[i] >> turn & 1
                total -= math.log2(probability(signs[i - depth:i][::-1], node, bit, 0))
                node = 2 * node + bit
        return total
    return bits, log_pw, count


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


@pytest.mark.parametrize("depth,frequent", [(2, 1 << 18), (3, 40), (4, 0)])
def test_code_lengths_against_brute_force(spark, words, depth, frequent):
    rnd = random.Random(depth)
    texts = [" ".join(rnd.choices(words[:30], k=rnd.randint(0, 25))).title() for _ in range(40)]
    rows = [(i, t, i % 4 != 1) for i, t in enumerate(texts)] + [(40, None, True), (41, "", False), (42, "日本é x\n", True),
                                                               (43, "Zz qq unseen", False), (1, texts[1], True), (None, "Ab", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, training boolean").withColumn("n", F.lit("own"))
    got = ctw.score(docs, F.col("training"), depth, frequent).collect()
    bits, _, _ = brute_ctw([lower(t).encode() for _, t, f in rows if f], depth)
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None]
    known = Counter(w for _, t, f in rows if f for w in tokens(t))
    total = sum(known.values())
    want = []
    for i, t, _ in rows:
        own = tokens(t)
        base = sum(math.log10((known[w] + .5) / (total + .5 * (len(known) + 1))) for w in own)
        want.append((i, len(own), sum(known[w] > 0 for w in own), total, base, len(lower(t).encode()) + 1,
                     -math.log10(2) * bits(lower(t).encode())))
    assert len(got) == len(want)
    by = lambda r: (r[0] is None, r[0], r[6])
    for g, w in zip(sorted(map(tuple, got), key=by), sorted(want, key=by)):
        assert g[:4] == w[:4] and g[5] == w[5]
        assert g[4] == pytest.approx(w[4], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_mixture_is_the_ratio_of_weighted_probabilities():
    """P(bit | training) = Pw(training and bit) / Pw(training) at the root."""
    training, depth = [b"abracadabra", b"abba"], 2
    bits, log_pw, count = brute_ctw(training, depth)
    before = sum(log_pw((b"", node)) for _, node in [k for k in count if k[0] == b""])
    first = bits(b"")                                            # the end sign alone, at a text's start
    _, after_pw, after_count = brute_ctw([*training, b""], depth)
    after = sum(after_pw((b"", node)) for _, node in [k for k in after_count if k[0] == b""])
    # the end sign's decisions lie on eight different trees, so the product is exact
    assert (before - after) / math.log(2) == pytest.approx(first, rel=1e-9)


def test_scoring_of_odd_rows(spark, odd, empty):
    got = ctw.score(odd).collect()
    assert len(got) == odd.count() and all(r.score <= 0 and r.n_known == r.n_tokens for r in got)
    assert ctw.score(empty).count() == 0
    none = ctw.score(odd, F.lit(False)).collect()
    assert all(r.base_score == 0 and r.n_known == 0 and r.score == pytest.approx(-math.log10(2) * 8 * r.n_signs)
               for r in none)
    # learned text costs less than the same bytes shuffled
    rnd = random.Random(1)
    text = next(r.text for r in odd.collect() if r.doc_id == 8)
    mixed = "".join(rnd.sample(text, len(text)))
    docs = spark.createDataFrame([(1, text, True), (2, text, False), (3, mixed, False)], "doc_id long, text string, t boolean")
    one, two, three = (r.score for r in sorted(ctw.score(docs, F.col("t")).collect()))
    assert one == pytest.approx(two) and two > 0.7 * three


def test_counter_hands_on_in_bounded_parts():
    rnd = np.random.default_rng(3)
    keys = rnd.integers(0, 3000, 20000).astype(np.uint64)
    flag = rnd.random(20000) < 0.5
    held, total, all_ = ctw._Counter(1), Counter(), Counter()
    for i in range(0, 20000, 1000):
        held.add(keys[i:i + 1000], flag[i:i + 1000])
        got = held.take(2000)
        for k, (n, n_all) in zip(*(got or ((), ()))):
            total[int(k)] += int(n)
            all_[int(k)] += int(n_all)
    for k, (n, n_all) in zip(*(held.take(0) or ((), ()))):
        total[int(k)] += int(n)
        all_[int(k)] += int(n_all)
    assert +total == Counter(keys[flag].tolist()) and all_ == Counter(keys.tolist())


def test_known_keys():
    rnd = np.random.default_rng(2)
    for width in (1, 2):
        keys = np.unique(rnd.integers(0, 5000, size=(3000, width)).astype(np.uint64), axis=0)
        known = ctw.Known(keys, np.arange(len(keys)))
        asked = rnd.integers(0, 5000, size=(5000, width)).astype(np.uint64)
        at = {tuple(k): i for i, k in enumerate(keys.tolist())}
        assert known.find(asked).tolist() == [at.get(tuple(k), -1) for k in asked.tolist()]
    assert ctw.Known(np.zeros(0, np.uint64), np.zeros(0)).find(np.arange(5, dtype=np.uint64)).tolist() == [-1] * 5


# operator 13 ----------------------------------------------------------------
def brute_middle(i, text, unit, seed, rate, spm):
    text = text or ""
    units = list(text) if unit == "char" else re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * j:8 * j + 8], 16) for j in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return i, len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return i, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit,rate,spm", [("line", 100, 50), ("char", 60, 30)])
def test_middle_against_brute_force(spark, odd, empty, unit, rate, spm):
    rnd = random.Random(6)
    parts = ["\n", "\n\n", "a", "é", "日本", "\r\n", "x" * 9, " ", "😀", "\x0b", " ", "<P", "<M>"]
    rows = [(i, "".join(rnd.choices(parts[:-1] if i % 9 else parts, k=rnd.randint(0, 60)))) for i in range(600)]
    rows += [(r.doc_id, r.text) for r in odd.collect()] + [(900, "\n" * 5000), (901, "a\n" * 20000 + "b"), (902, "<S")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("own"), "h1": F.lit(3)})
    made = fim.fill_in_middle(docs, unit, "5", rate, spm)
    got = fim.restore(made).collect()
    key = lambda r: str(r[:6])
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(
        (brute_middle(i, t, unit, "5", rate, spm) for i, t in rows), key=key)
    assert sorted((r.doc_id or 0, r.restored) for r in got) == sorted((i or 0, t or "") for i, t in rows)
    assert fim.restore(fim.fill_in_middle(empty)).count() == 0


def test_rank_and_select_of_marks():
    rnd = np.random.default_rng(0)
    for n in (0, 1, 7, 8, 9, 64, 1000):
        for share in (0.02, 0.5, 1.0):
            data = np.where(rnd.random(n) < share, 0x0A, rnd.integers(0, 256, n)).astype(np.uint8)
            marks = fim.Marks(fim.equal_to(fim.words_of(data), 0x0A))
            at = np.flatnonzero(data == 0x0A)
            assert marks.select(np.arange(len(at))).tolist() == at.tolist()
            assert marks.rank(np.arange(n + 1)).tolist() == np.searchsorted(at, np.arange(n + 1)).tolist()
            first = np.flatnonzero((data & 0xC0) != 0x80)
            assert fim.Marks(fim.first_bytes(fim.words_of(data))).select(np.arange(len(first))).tolist() == first.tolist()


def test_slices_of_units_agree_with_the_whole():
    texts = ["é\nb", "", "\n", "abc", "x\ny\nz\n"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    whole = fim.Units(data, off, 0, 5, "line")
    for lo, hi in byte_slices(off, 4):
        part = fim.Units(data, off, lo, hi, "line")
        assert part.count.tolist() == whole.count[lo:hi].tolist() == [
            len(re.findall(r"[^\n]*\n|[^\n]+", t)) for t in texts[lo:hi]]
