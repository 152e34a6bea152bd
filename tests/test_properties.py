"""Properties: spans slice back to their terms, no overlaps after de-overlap,
draws independent of partitioning, BIO -> chunks -> BIO round trip."""

from pyspark.sql import functions as F

from spanforge.operators import bio, sampling
from spanforge.plans import bindings as B
from spanforge.plans import scoring


def test_spans_slice_back(spark, sf):
    from spanforge.operators.spans import find_spans_next
    r = B.entity_requests(spark, sf).withColumn("sp", find_spans_next(F.col("sentence"), F.col("entities")))
    z = r.select("sentence", F.inline_outer(F.arrays_zip(F.col("entities").alias("e"), F.col("sp").alias("s"))))
    bad = z.where((F.col("s.start") >= 0) & (F.lower(F.substring("sentence", F.col("s.start") + 1,
                                                                 F.col("s.stop") - F.col("s.start")))
                                             != F.lower("e.text")))
    assert bad.count() == 0


def test_no_overlaps_after_filter(spark, sf):
    g = scoring.gazetteer_entities(spark, sf)
    # ents are sorted by start: no overlap iff each span ends before the next starts
    e = F.col("ents")
    clash = F.exists(F.sequence(F.lit(1), F.greatest(F.size(e) - 1, F.lit(1))),
                     lambda k: F.get(e, k - 1)["end_tok"] > F.get(e, k)["first_tok"])
    assert g.select(F.sum(F.when(clash, 1).otherwise(0))).first()[0] == 0


def test_draws_partition_independent(spark, sf):
    def draws(n):
        r = B.table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id")).repartition(n)
        return sorted(tuple(x) for x in r.select("row_id", F.array_join(
            sampling.random_shape(42, F.col("row_id")), ",")).collect())
    assert draws(1) == draws(7)


def test_bio_round_trip(spark, sf):
    gp = scoring.gold_and_predicted(spark, sf)
    ids = F.transform("gold_chunks", lambda c: F.when(c["type"] == "Medikation", 0)
                      .when(c["type"] == "Dosis", 1).otherwise(2))
    back = gp.select("gold_tags", bio.chunks_to_tags(F.size("gold_tags"), F.col("gold_chunks"), ids).alias("b"))
    assert back.select(F.sum(F.when(F.col("gold_tags") != F.col("b"), 1).otherwise(0))).first()[0] == 0
