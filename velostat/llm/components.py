"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velostat.llm.common import stage


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v: BIGINT): root is the
    smallest node that can be reached.

    Each round takes the smallest label among the neighbours, then the label of
    that label (pointer jumping), so the rounds grow with the logarithm of the
    longest path.  Every round is a staged table; nothing comes to the driver but
    the number of labels that changed."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = stage(both.where("u <> v").distinct(), "cc-edges")
    labels = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("_near"))
    labels = stage(labels.select("node", F.least("node", "_near").alias("root")), "cc-labels")
    while True:
        near = edges.join(labels, edges["v"] == labels["node"]).groupBy("u").agg(F.min("root").alias("_near"))
        step = labels.join(near, labels["node"] == near["u"]).select("node", "root", F.least("root", "_near").alias("_next"))
        jump = labels.select(F.col("node").alias("_next"), F.col("root").alias("_jump"))
        step = step.join(jump, "_next").select("node", F.least("_next", "_jump").alias("root"), (F.least("_next", "_jump") != F.col("root")).alias("_moved"))
        step = stage(step, "cc-labels")
        moved = step.agg(F.coalesce(F.sum(F.col("_moved").cast("bigint")), F.lit(0))).first()[0]
        labels = step.select("node", "root")
        if not moved:
            return labels
