"""Personal data and the words that disclose it (operator 2).

Base: e-mail addresses, IP addresses, card numbers and phone numbers by pattern.
Method: every distinct base value is a protected entity.  Over the whole corpus the
words within ``reach`` words of an entity's mentions are counted with it.  A word
tells p(entity | word) = k / (n + m): of n occurrences k near the entity, and one
more, not near it, for each of the m entities it was seen near at least as often (1
if the entity is the only one).  Copies count once: k is the number of different
surroundings, n all its occurrences scaled alike.  It tells log2 p(entity | word) /
p(entity) bits, p(entity) being the share of all words of the corpus that lie near
the entity.  A word that tells at least ``bits`` and ``probability`` about some entity
is sensitive wherever it occurs: generalised to ``<WORD>``, or removed from
``remove_from`` on.  A word seen once, beside one entity, has 1/2 and is generalised.

Words are runs of ASCII letters and digits and of other characters beyond ASCII,
A-Z lowered, told apart by 64-bit hashes.  Their counts over the corpus are taken for
words that may be candidates only; a Bloom filter sized by their number, up to a byte
bound, goes to the tasks to pick them, the exact choice is a join.  Rows are told apart
by a 128-bit hash of (doc_id, text); exactly repeated rows have the same spans.

Defined results: a null or empty text has no spans; rows that repeat a doc_id keep
their own spans; null doc_ids stay; other columns pass through; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .bloom import bloom, join_few
from .scratch import map_batches, materialise, release, row_key
from .wordarrays import BYTE_VALUE, Words, buffer_of, byte_slices, mix64, string_column

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never starts inside a run of digits whose start didn't match
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile("[0-9@]")

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_VALUE = BYTE_VALUE.copy()
_VALUE[65:91] = BYTE_VALUE[97:123]


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    lo, at = 0, text.find("@")
    while at >= 0:
        start, found = at, None
        while start > lo and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            found = _DOMAIN.match(text, at + 1)
        if found:
            yield start, found.end()
            lo = found.end()
        at = text.find("@", max(lo, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base spans, by start, then kind."""
    if not _ANY.search(text):
        return []
    out = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        # no conversion of unbounded length: int() refuses more than 4,300 digits
        parts = [x.lstrip("0") for x in m.group().split(".")]
        if all(len(x) <= 3 and int(x or "0") <= 255 for x in parts):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _words(data: np.ndarray, off: np.ndarray, lo: int, hi: int) -> tuple[Words, np.ndarray]:
    words = Words(data, off, lo, hi, _BETWEEN)
    return words, words.hashes(_VALUE)


def _near(text: str, spans: list[tuple[int, int, int]], reach: int) -> list[dict]:
    """The words around each base span: hashes of the word, the entity and the surroundings."""
    raw = np.frombuffer(text.encode(), np.uint8)
    words, hashes = _words(raw, np.array([0, len(raw)]), 0, 1)
    places = [(len(text[:s].encode()), len(text[:e].encode())) for s, _, e in spans]
    inside = np.zeros(len(hashes), dtype=bool)
    for s, e in places:
        inside[np.searchsorted(words.end, s, side="right"):np.searchsorted(words.start, e)] = True
    free = np.flatnonzero(~inside)
    start, h = words.start[free], hashes[free]
    out = []
    for (s, _), (cs, kind, ce) in zip(places, spans):
        value = re.sub("[^0-9]", "", text[cs:ce]) if kind >= 2 else text[cs:ce].lower()
        entity = xxhash.xxh64_intdigest(f"{kind}:{value}") >> 1
        at = int(np.searchsorted(start, s))
        around = h[max(0, at - reach):at + reach]
        context = int(xxhash.xxh64_intdigest(around.tobytes()) >> 1)
        out += [{"term": int(t), "entity": entity, "context": context} for t in around.view(np.int64)]
    return out


def find_base(docs: DataFrame, reach: int = 6) -> DataFrame:
    """``(doc_id, a, b, base, near)`` per row: its key, its base spans and the words
    around them."""
    docs = docs.select("doc_id", row_key(1).alias("a"), row_key(2).alias("b"), "text")
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    word = pa.list_(pa.struct([("term", pa.int64()), ("entity", pa.int64()), ("context", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, near = [], []
            for t in b.column(3):
                text = t.as_py() or ""
                spans = base_spans(text)
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                near.append(_near(text, spans, reach) if spans else [])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(base, span), pa.array(near, word)],
                names=["doc_id", "a", "b", "base", "near"])

    return map_batches(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, a long, b long, "
                                "base array<struct<start:int,kind:int,end:int>>, "
                                "near array<struct<term:long,entity:long,context:long>>")


def _corpus_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term, n)``: occurrences in the whole corpus of the given terms, and under a
    null term the number of all words."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom(terms.select("term")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = buffer_of(string_column(b.column(0)))
            for lo, hi in byte_slices(off):
                _, h = _words(data, off, lo, hi)
                term, n = np.unique(h[shared.value.may_hold(h)], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*term.view(np.int64).tolist(), None], pa.int64()), pa.array([*n.tolist(), len(h)], pa.int64())],
                    names=["term", "n"])

    counts = map_batches(docs.select("text"), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return materialise(counts, "counts")


def sensitive_terms(docs: DataFrame, found: DataFrame, probability: float = 0.5, bits: float = 6.0,
                    remove_from: float = 0.9) -> DataFrame:
    """``(term, remove)``: hashes of the words that disclose an entity."""
    near = found.select(F.inline("near"))
    pairs = materialise(
        near.groupBy("term", "entity", "context").agg(F.count("*").alias("n"))
        .groupBy("term", "entity").agg(F.count("*").alias("contexts"), F.sum("n").alias("together")), "pairs")
    own = near.groupBy("entity").agg(F.count("*").alias("own"))
    counts = _corpus_counts(docs, pairs.select("term").distinct())
    words = counts.filter("term is null").select(F.col("n").alias("words"))          # one row
    # per term: how many entities have how many surroundings with it (a few numbers, no list of entities)
    seen = (pairs.groupBy("term", "contexts").agg(F.count("*").alias("entities"))
            .groupBy("term").agg(F.collect_list(F.struct("contexts", "entities")).alias("seen")))
    rivals = F.aggregate(F.filter("seen", lambda x: x["contexts"] >= F.col("contexts")),
                         F.lit(0).cast("long"), lambda a, x: a + x["entities"])
    # a word between two mentions of an entity is near both, but occurs once
    k, together = F.least("contexts", "n"), F.least("together", "n")
    told = (pairs.join(counts.join(seen, "term"), "term").join(own, "entity").join(F.broadcast(words))
            .withColumn("p", k * together / (k * F.col("n") + rivals * together))   # k / (n k / together + rivals)
            .filter((F.col("p") >= probability)
                    & (F.log2(F.col("p") / F.least(F.lit(1.0), F.col("own") / F.col("words"))) >= bits)))
    return materialise(told.groupBy("term").agg((F.max("p") >= remove_from).alias("remove")), "terms")


def find_terms(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(__a, __b, __terms)``: spans of sensitive words, for rows that have some; rows
    by their key."""
    docs = docs.select(row_key(1).alias("a"), row_key(2).alias("b"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(bloom(terms.select("term")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = buffer_of(string_column(b.column(2)))
            for lo, hi in byte_slices(off):
                words, h = _words(data, off, lo, hi)
                at = np.flatnonzero(shared.value.may_hold(h))
                # code points: bytes that don't go on with a character
                points = np.concatenate(([0], np.cumsum((words.data & 0xC0) != 0x80)))
                row = np.searchsorted(words.row, at, side="right") - 1
                first = points[words.off[row]]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row + lo)), b.column(1).take(pa.array(row + lo)),
                     pa.array(h[at].view(np.int64)), pa.array((points[words.start[at]] - first).astype(np.int32)),
                     pa.array((points[words.end[at]] - first).astype(np.int32))],
                    names=["a", "b", "term", "start", "end"])

    hits = map_batches(docs, run, "a long, b long, term long, start int, end int")
    found = (hits.join(terms, "term").groupBy(F.col("a").alias("__a"), F.col("b").alias("__b"))
             .agg(F.collect_set(F.struct("start", "end", "remove")).alias("__terms")))   # bounded by the row's words
    return materialise(found, "found")


def spans(docs: DataFrame, reach: int = 6, **thresholds) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, base, terms)`` per row: base spans (start, kind
    number in ``KINDS``, end) and spans of sensitive words (start, end, remove) that
    touch no base span; code points, end exclusive."""
    found = materialise(find_base(docs, reach), "base")
    terms = sensitive_terms(docs, found, **thresholds)
    both = join_few(found.select("doc_id", "a", "b", "base"), find_terms(docs, terms), [("a", "__a"), ("b", "__b")])
    free = F.filter(F.coalesce("__terms", F.array().cast("array<struct<start:int,end:int,remove:boolean>>")),
                    lambda t: ~F.exists("base", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return both.select("doc_id", "base", F.array_sort(free).alias("terms"))


def sanitise(docs: DataFrame, reach: int = 6, **thresholds) -> DataFrame:
    """``docs`` with the base spans replaced by ``<EMAIL>``, ``<IP>``, ``<CARD>``,
    ``<PHONE>`` in ``text`` (of overlapping ones the first), sensitive words by
    ``<WORD>`` or by nothing; other texts and columns stay."""
    found = materialise(find_base(docs, reach), "base")
    terms = sensitive_terms(docs, found, **thresholds)
    names = docs.columns
    at = names.index("text")
    release(found)
    keyed = docs.select("*", row_key(1).alias("__own_a"), row_key(2).alias("__own_b"))
    joined = join_few(keyed, find_terms(docs, terms), [("__own_a", "__a"), ("__own_b", "__b")]).select(
        *[f"`{c}`" for c in names], "__terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = []
            for t, words in zip(b.column(at), b.column(len(names))):
                text = t.as_py()
                cuts = [(s, e, f"<{KINDS[k].upper()}>") for s, k, e in base_spans(text or "")]
                cuts += [(w["start"], w["end"], "" if w["remove"] else "<WORD>") for w in words.as_py() or ()
                         if not any(s < w["end"] and w["start"] < e for s, e, _ in cuts)]
                if cuts:
                    parts, done = [], 0
                    for s, e, sign in sorted(cuts):
                        if s >= done:
                            parts += [text[done:s], sign]
                            done = e
                        else:                # overlaps the one before: its rest goes too
                            done = max(done, e)
                    text = "".join([*parts, text[done:]])
                new.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, pa.string()) if i == at else b.column(i) for i in range(len(names))], names=names)

    return map_batches(joined, run, docs.schema)
