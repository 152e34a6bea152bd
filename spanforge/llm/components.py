"""Connected components as Spark joins: minimum-label hooking with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import materialise, release


def connected_components(edges: DataFrame) -> DataFrame:
    """``(src, dst)`` undirected links -> ``(node, component)`` where component is
    the smallest node reachable.

    Every node that occurs in a link has one row; self links are allowed.  Each
    round takes the smallest label among a node's neighbours, hooks the node's
    root under it and jumps one pointer, so a chain halves per round.  The
    aggregates combine map-side and the joins are plain equi-joins which adaptive
    execution can split, so a node with very many links is no single task.  No
    link or label reaches the driver; it sees one changed-count per round.
    """
    both = materialise(
        edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        .distinct(), "links")
    labels = materialise(both.groupBy(F.col("src").alias("node"))
                         .agg(F.min("dst").alias("low"))
                         .select("node", F.least("node", "low").alias("component")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("dst"), F.col("component").alias("near")), "dst")
                .groupBy(F.col("src").alias("node")).agg(F.min("near").alias("near")))
        seen = labels.join(near, "node", "left").select(
            "node", "component", F.least("component", F.coalesce("near", "component")).alias("low"))
        # hook: the root of a node takes the smallest label seen by its members
        hooks = seen.groupBy(F.col("component").alias("root")).agg(F.min("low").alias("hook"))
        hooked = seen.join(hooks, seen["component"] == hooks["root"]).select(
            "node", F.col("component").alias("was"), F.least("low", "hook").alias("now"))
        hooked = materialise(hooked, "hooked")
        jump = hooked.select(F.col("node").alias("now"), F.col("now").alias("next"))
        old, labels = labels, materialise(hooked.join(jump, "now", "left").select(
            "node", F.least("now", F.coalesce("next", "now")).alias("component"),
            (F.least("now", F.coalesce("next", "now")) != F.col("was")).alias("changed")), "labels")
        release(old, hooked)
        if labels.filter("changed").limit(1).count() == 0:
            release(both)
            return labels.select("node", "component")
