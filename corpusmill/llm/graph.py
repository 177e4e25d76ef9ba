"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Each round takes the smallest label among the neighbours and then the label's own label, so chains shrink by
    powers of two. Only minima per node are aggregated; no neighbourhood is gathered anywhere.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    both = cut(both.distinct())
    held = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("n")).select("node", F.least("node", "n").alias("next")))
    while True:
        labels = held.select("node", F.col("next").alias("label"))
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = cut(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next")))
        parents = hooked.select(F.col("node").alias("next"), F.col("next").alias("above"))
        jumped = cut(hooked.join(parents, "next").select("node", "label", F.least("next", "above").alias("next")))
        drop(held, hooked)
        if not jumped.filter("next <> label").limit(1).count():
            drop(both)
            return jumped.select("node", F.col("next").alias("component"))
        held = jumped
