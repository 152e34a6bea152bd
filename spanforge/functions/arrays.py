"""Array helpers that stay row-local (no explode, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefix_sum(arr: Column) -> Column:
    """Inclusive prefix sum of an integer array in O(n log n), JVM-side.

    Hillis–Steele doubling: step k adds the value 2^k places to the left.
    A fold with ``concat`` would copy the accumulator on every element
    (O(n^2)), which explodes on one-line documents of 30k+ tokens.
    """
    steps = F.transform(F.sequence(
        F.lit(0),
        F.greatest(F.ceil(F.log2(F.greatest(F.size(arr), F.lit(1)))).cast("int"), F.lit(1)) - 1,
    ), lambda k: F.call_function("shiftleft", F.lit(1), k))        # the distances, computed once a row

    def step(acc, d):
        return F.transform(acc, lambda x, i: F.when(i < d, x).otherwise(x + F.get(acc, i - d)))

    return F.aggregate(steps, arr, step)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once, inside a lambda too (where an
    expression used twice is computed twice)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_leading(arr: Column, holds) -> Column:
    """How many leading elements satisfy ``holds``, which is true up to some element and
    false from there on: a binary search, O(log n) looks into the array."""
    n = F.size(arr)
    steps = F.sequence(F.lit(1), F.greatest(F.ceil(F.log2(n + F.lit(1))).cast("int"), F.lit(1)))

    def step(acc, _):
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        return F.when(acc["lo"] >= acc["hi"], acc).when(
            holds(F.get(arr, mid)), F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi"))).otherwise(
            F.struct(acc["lo"].alias("lo"), mid.alias("hi")))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), n.alias("hi")), step, lambda acc: acc["lo"])


def pin(c: Column) -> Column:
    """Evaluate ``c`` once per row.

    Catalyst inlines a projected expression into its single consumer, and it
    counts a reference inside a lambda as one — so an array built by an
    expensive expression and then indexed inside ``transform``/``filter``
    would be rebuilt for every element.  An always-true non-deterministic
    guard makes the producing projection non-collapsible (and stops filters
    being pushed through it); the value is unchanged.  A bare ``rand() >= 0`` would be
    folded to true by the optimizer and guard nothing, so its magnitude is compared."""
    return F.when(F.abs(F.rand(0)) >= F.lit(0.0), c)
