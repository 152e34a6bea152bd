"""SimHash near-duplicates by multi-index hashing (operator 10).

Fingerprints: A-Z lowered, words ``[^\\x20\\x09-\\x0D]+``, word shingles with
repeats, XXH64 (UTF-8, seed 42) per shingle, a bit is 1 if set in over half of
the hashes.  Links: the 64 bits are cut into segments, whose number follows from the
count of fingerprints (``segments_for``); every number gives the same links.  Two
fingerprints within ``max_bits`` agree in some segment up to that segment's radius.
Each distinct fingerprint is stored under its own segment values and looked up
under every value of the segment's Hamming ball; table matches are verified on
the complete 64 bits.  Within a table entry members are compared with its smallest
one first, then only across the components found so far, so a large group of
near-copies costs a pair per member.  For a differing bit exactly one of two values has it set,
so a probe only clears set bits or keeps the value, and each side probes: every
pair is still met, at half the probes.  With a radius over one a fingerprint is also
stored under the smaller ball that the other side's probes leave over.

Defined results: a null or empty text has fingerprint 0 and is linked like any
other; equal fingerprints are one node, so copies are never paired; repeated rows
give repeated result rows; a null ``doc_id`` never names a component unless all
its members are null; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .bloom import cells_of, may_match
from .components import connected_components
from .scratch import map_batches, materialise, release, row_key

_digest = xxhash.xxh64_digest
_BLOCK = 1 << 18
_ROW = 32       # a row written to or looked up in a table costs about as much as so many comparisons


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    del words
    last = ends[shingle - 1:] if len(ends) >= shingle else ends[-1:]
    starts = np.concatenate(([0], ends + 1))[: len(last)]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(last), _BLOCK):
        hashes = b"".join([_digest(line[s:e], 42) for s, e in
                           zip(starts[at:at + _BLOCK].tolist(), last[at:at + _BLOCK].tolist())])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(last)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, fp)``; fp as a signed long, a row per row.
    The columns ``keep`` (longs) go with it."""
    docs = docs.select("doc_id", "text", *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp, *b.columns[2:]], names=["doc_id", "fp", *keep])

    return map_batches(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long"
                       + "".join(f", {c} long" for c in keep))


def _segments(segments: int, max_bits: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment needed; widths differ by one at most.

    With q, r = divmod(max_bits, segments) the first r + 1 segments get radius q and the
    others q - 1: two values beyond all of these radii differ in (r + 1)(q + 1) +
    (segments - r - 1) q = max_bits + 1 bits at least.  A segment of radius -1 isn't needed.
    """
    cuts = [64 * i // segments for i in range(segments + 1)]
    q, r = divmod(max_bits, segments)
    found = [(a, b - a, q if i <= r else q - 1) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return [s for s in found if s[2] >= 0]


def segments_for(count: int, max_bits: int, most: int = 3) -> int:
    """The number of segments, up to ``most``, that costs least for ``count`` fingerprints.

    Few long segments need large balls, that is rows; many short ones have so few values
    that fingerprints meet by chance.  Rows and chance meetings are those of values with
    half of their bits set.
    """
    def cost(segments: int) -> float:
        total = 0.0
        for _, width, radius in _segments(segments, max_bits):
            stored, looked = (sum(math.comb(width // 2, i) for i in range(r + 1)) for r in (radius // 2, radius))
            total += _ROW * (stored + looked) + stored * looked * count / 2 ** width
        return total

    return min(range(1, max(1, min(most, max_bits)) + 1), key=cost)


def _value(shift: int, width: int):
    return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))


def _ball(value, width: int, radius: int):
    """The value with up to ``radius`` of its set bits cleared."""
    ball = F.array(value)
    for _ in range(radius):
        ball = F.array_distinct(F.flatten(F.transform(ball, lambda v: F.concat(
            F.array(v), F.transform(F.sequence(F.lit(0), F.lit(width - 1)),
                                    lambda i: v.bitwiseAND(F.bitwise_not(F.call_function(
                                        "shiftleft", F.lit(1).cast("long"), i))))))))
    return ball


def _near(a: str, b: str, max_bits: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def _tables(prints: DataFrame, max_bits: int, segments: int) -> tuple[DataFrame, DataFrame]:
    """``(fp, seg, key)`` rows: where fingerprints are stored, and where they look.

    Two values whose bits differ by d in a segment meet at the value with the d bits
    cleared on whichever side has them set.  One side has d // 2 of them at most: stored
    under its ball of radius // 2, it is found by the other side's ball of the radius.
    """
    def keyed(number: int):
        return lambda v: F.struct(F.lit(number).alias("seg"), v.alias("key"))

    table, probes = [], []
    for i, (shift, width, radius) in enumerate(_segments(segments, max_bits)):
        own = _value(shift, width)
        table.append(F.transform(_ball(own, width, radius // 2), keyed(i)))
        probes.append(F.transform(_ball(own, width, radius), keyed(i)))
    return prints.select("fp", F.inline(F.concat(*table))), prints.select("fp", F.inline(F.concat(*probes)))


def links(prints: DataFrame, max_bits: int = 4, segments: int | None = None) -> DataFrame:
    """Distinct ``fp`` -> every ``(src, dst)`` within ``max_bits``, src < dst."""
    stored, looked = _tables(prints, max_bits, segments or segments_for(prints.count(), max_bits))
    a, b = looked.withColumnRenamed("fp", "a"), stored.withColumnRenamed("fp", "b")
    return (a.join(b, (a["seg"] == b["seg"]) & (a["key"] == b["key"]) & (F.col("a") != F.col("b")) & _near("a", "b", max_bits))
            .select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct())


def components(prints: DataFrame, max_bits: int = 4, segments: int | None = None) -> DataFrame:
    """Distinct ``fp`` -> ``(node, component)`` of those that have a link.

    The components of all links, without forming all links of a large group.  First
    each table entry's members are compared with its smallest one, a pair per member.
    Then, in the components this gives, only pairs of different components matter,
    and one of the two isn't in the smallest one's component: members outside it are
    compared with all, members inside it with those outside.
    """
    stored, looked = _tables(prints, max_bits, segments or segments_for(prints.count(), max_bits))
    entries = stored.groupBy("seg", "key").agg(F.min("fp").alias("first"), F.count("*").alias("n"))
    entries = materialise(entries, "entries")      # a table: the join below can split a hot entry
    # an entry of one member needs no second round: only its verified matches stay
    near_first = (F.col("fp") != F.col("first")) & _near("fp", "first", max_bits)
    at = entries.withColumnsRenamed({"seg": "__seg", "key": "__key"})
    met = materialise(looked.join(at, (looked["seg"] == at["__seg"]) & (looked["key"] == at["__key"])
                                  & ((F.col("n") > 1) | near_first)).drop("__seg", "__key"), "met")
    star = materialise(met.filter(near_first).select(
        F.least("fp", "first").alias("src"), F.greatest("fp", "first").alias("dst")).distinct(), "star")
    root = connected_components(star)

    def rooted(df: DataFrame, fp: str, name: str) -> DataFrame:
        r = root.select(F.col("node").alias("__node"), F.col("component").alias("__component"))
        return (df.join(r, df[fp] == r["__node"], "left").drop("__node")
                .withColumn(name, F.coalesce("__component", fp)).drop("__component"))

    places = met.groupBy("seg", "key").agg(F.first("first").alias("first"))       # one value per entry
    places = rooted(places, "first", "top")
    askers = rooted(met.select("seg", "key", "fp"), "fp", "root").join(places.drop("first"), ["seg", "key"])
    members = rooted(stored, "fp", "root").join(places.drop("first"), ["seg", "key"])
    askers, members = materialise(askers, "askers"), materialise(members, "members")

    def across(left: DataFrame, right: DataFrame) -> DataFrame:
        x = left.select("seg", "key", F.col("fp").alias("a"), F.col("root").alias("ra"))
        y = right.select("seg", "key", F.col("fp").alias("b"), F.col("root").alias("rb"))
        return (x.join(y, (x["seg"] == y["seg"]) & (x["key"] == y["key"]) & (F.col("ra") != F.col("rb"))
                       & _near("a", "b", max_bits))
                .select(F.least("ra", "rb").alias("src"), F.greatest("ra", "rb").alias("dst")))

    outside, inside = F.col("root") != F.col("top"), F.col("root") == F.col("top")
    more = across(askers.filter(outside), members).union(across(askers.filter(inside), members.filter(outside)))
    return connected_components(star.union(more.distinct()))


def _rooted(prints: DataFrame, max_bits: int, segments: int | None) -> DataFrame:
    """Distinct ``fp`` and other columns -> the same with ``root``, its component."""
    groups = components(prints.select("fp"), max_bits, segments)
    return (prints.join(groups, prints["fp"] == groups["node"], "left")
            .withColumn("root", F.coalesce("component", "fp")).drop("node", "component"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, segments: int | None = None) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, fp, component_id)``, a row per row;
    component_id is the smallest doc_id whose fingerprint is reachable."""
    rows = materialise(fingerprints(docs, shingle), "fingerprints")
    prints = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "prints")
    named = _rooted(prints, max_bits, segments)
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, shingle: int = 4, max_bits: int = 4, segments: int | None = None) -> DataFrame:
    """Documents without the near-duplicates, decided row by row: of the rows of a
    component the one with the smallest (doc_id, hash of the row) stays, a null doc_id
    last.  Of rows that agree in doc_id and text one stays, the one whose other columns
    have the smallest hash.

    The decision is made on keys.  Only rows that may be judged (a bitmap of the judged
    keys tells) meet it in a join; the texts of the others, which are most, are
    not moved."""
    names = docs.columns
    columns = [F.col(f"`{c}`") for c in names]
    keyed = docs.select("*", row_key(1).alias("__a"), row_key(2).alias("__b"))
    prints = fingerprints(keyed, shingle, ("__a", "__b"))
    rows = materialise(prints.groupBy("__a", "__b").agg(
        F.first("doc_id").alias("doc_id"), F.first("fp").alias("fp"), F.count("*").alias("n")), "rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__a", "__b")).alias("first")
    prints = materialise(rows.groupBy("fp").agg(first), "prints")
    best = (_rooted(prints, max_bits, segments).groupBy("root").agg(F.min("first").alias("first"))
            .select(F.col("first.__a").alias("__first_a"), F.col("first.__b").alias("__first_b")))
    judged = rows.join(best, (rows["__a"] == best["__first_a"]) & (rows["__b"] == best["__first_b"]), "left").select(
        F.col("__a").alias("__row_a"), F.col("__b").alias("__row_b"), F.col("__first_a").isNotNull().alias("__stays"), "n")
    judged = materialise(judged.filter("not __stays or n > 1").drop("n"), "judged")   # most rows stay and are single
    release(rows, prints)
    found = cells_of(judged.select("__row_a"))
    # written before they are counted together, so that the join can split a hot row
    asked = may_match(keyed, "__a", found)
    asked = materialise(asked.join(judged, (asked["__a"] == judged["__row_a"]) & (asked["__b"] == judged["__row_b"]),
                                   "left").filter("__stays is null or __stays").drop("__row_a", "__row_b"), "asked")
    single = may_match(keyed, "__a", found, keep=False).select(*columns).union(
        asked.filter("__stays is null").select(*columns))
    others = F.xxhash64(F.to_json(F.struct(*[c for c, n in zip(columns, names) if n not in ("doc_id", "text")], F.lit(0))))
    one = (asked.filter("__stays").groupBy("__a", "__b").agg(F.min_by(F.struct(*columns), others).alias("__row"))
           .select(*[F.col(f"__row.`{n}`").alias(n) for n in names]))
    return single.union(one)
