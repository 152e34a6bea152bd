"""Seeded, partition-independent sampling.

The reference draws from one sequential ``random.Random``; here each draw is a
keyed hash ``u32(seed, row, slot, salt)``, so rows are independent, any task
can be retried or re-planned and the same rows come out.  Draw distributions
equal the reference's; the exact Mersenne-Twister sequence is not reproduced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.functions.hashing import draw_index, md5_order_key, unit_draw
from spanforge.functions.text import py_float_text
from spanforge.schemas import (CONTEXTS, NO_SPACE_SHARE, RANDOM_SHAPE_DIAG_COUNTS, RANDOM_SHAPE_DOSE_COUNTS,
                               RANDOM_SHAPE_MED_COUNTS, SHAPES, STYLES)
from spanforge.session import cut_lineage


def seeded_shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Global order by ``md5(seed|key)`` (ties by key) — a distributed
    range sort, identical under any partitioning (``rand(seed)`` is not)."""
    return df.withColumn("shuffle_key", md5_order_key(seed, F.col(key))).orderBy("shuffle_key", key)


def literal_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def choose(values: list, seed, row: Column, *salt) -> Column:
    """C1/C2/C8 for a fixed list: uniform choice by keyed hash."""
    return F.get(literal_array(values), draw_index(len(values), seed, row, *salt))


def dense_index(lex: DataFrame, order: list[str]) -> DataFrame:
    """0-based rank in ``order`` (a total order), computed distributed.

    Range-sort, then row position inside each sorted partition plus the size
    of all earlier partitions (one tiny per-partition count).  The sorted
    data is checkpointed first so both passes see the same partitions."""
    s = lex.orderBy(*order).withColumn("__pid", F.spark_partition_id()) \
        .withColumn("__mid", F.monotonically_increasing_id())
    s = cut_lineage(s)
    counts = s.groupBy("__pid").agg(F.count("*").alias("__c"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("__off", F.coalesce(F.sum("__c").over(w), F.lit(0)))  # one row per partition
    j = s.join(F.broadcast(offs.select("__pid", "__off")), "__pid")
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return j.withColumn("idx", (F.col("__off") + local).cast("int")).drop("__pid", "__mid", "__off")


def draw_from(rows: DataFrame, terms: DataFrame, idx_expr: Column, out: str) -> DataFrame:
    """Attach the term at ``idx_expr`` of ``(idx, term)`` as ``out``: a join on the
    (uniform) index.  It is a merge join: by its file statistics a well compressed lexicon
    looks small enough to be broadcast, whatever its number of terms."""
    side = terms.select(F.col("idx").alias(f"__i_{out}"), F.col("term").alias(out)).hint("merge")
    r = rows.withColumn(f"__i_{out}", idx_expr)
    return r.join(side, f"__i_{out}", "left").drop(f"__i_{out}")


def shape_of(seed, row: Column, shapes=SHAPES) -> Column:
    """One label template per row."""
    arr = F.array(*[literal_array(s) for s in shapes])
    return F.get(arr, draw_index(len(shapes), seed, row, "shape"))


def random_shape(seed, row: Column) -> Column:
    """n_med in [0,1,1,2], n_diag in [0,1,1,2], n_dose in [0,1] only with a
    medication; never empty (-> [Diagnose]); order shuffled by keyed hash."""
    n_med = F.get(literal_array(RANDOM_SHAPE_MED_COUNTS), draw_index(4, seed, row, "n_med"))
    n_diag = F.get(literal_array(RANDOM_SHAPE_DIAG_COUNTS), draw_index(4, seed, row, "n_diag"))
    n_dose = F.when(n_med > 0, F.get(literal_array(RANDOM_SHAPE_DOSE_COUNTS), draw_index(2, seed, row, "n_dose"))).otherwise(0)
    labels = F.concat(F.array_repeat(F.lit("Medikation"), n_med), F.array_repeat(F.lit("Dosis"), n_dose),
                      F.array_repeat(F.lit("Diagnose"), n_diag))
    labels = F.when(F.size(labels) == 0, F.array(F.lit("Diagnose"))).otherwise(labels)
    keyed = F.transform(labels, lambda x, i: F.struct(F.md5(F.concat_ws("|", F.lit(str(seed)), row.cast("string"),
                                                                         i.cast("string"), F.lit("perm"))).alias("k"),
                                                      x.alias("label")))
    return F.transform(F.array_sort(keyed), lambda s: s["label"])


def dosage_text(value_text: Column, unit: Column, seed, row: Column, slot) -> Column:
    """Value and unit drawn independently; 70 % written without a space;
    then every '.' becomes ',' (in value and unit)."""
    glue = F.when(unit_draw(seed, row, slot, "space") < NO_SPACE_SHARE, F.lit("")).otherwise(F.lit(" "))
    return F.replace(F.concat(value_text, glue, unit), F.lit("."), F.lit(","))


def float_text(v: Column) -> Column:
    return py_float_text(v)


def sample_without_replacement(pool: Column, k: int, seed, row: Column) -> Column:
    """``k`` distinct pool elements, keyed-hash order; row-local, no shuffle."""
    keyed = F.transform(pool, lambda e, i: F.struct(
        F.md5(F.concat_ws("|", F.lit(str(seed)), row.cast("string"), i.cast("string"), F.lit("ex"))).alias("k"),
        i.alias("i"), e.alias("e")))
    return F.slice(F.array_sort(keyed), 1, k)


def style_context(seed, row: Column) -> tuple[Column, Column]:
    """Style (5) and context (6) draws."""
    return choose(STYLES, seed, row, "style"), choose(CONTEXTS, seed, row, "ctx")
