"""Connected components of an edge table: least label of each node, by label passing and jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalogia.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, label for every node of ``edges`` (a, b: long); label is the least node reachable.

    Each round a node takes the least label of itself, its neighbours and the node that its label
    names; the number of rounds grows with the logarithm of a component's diameter.  Least labels
    are gathered with map-side partial minima, so a node with very many neighbours costs no task
    more than its share.
    """
    both = stored(edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select("b", "a")).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                    .select("node", F.least("node", "near").alias("label")))
    while True:
        # Neighbours of a component hang under the root of the label, not under the node alone.
        offered = (
            both.join(labels.withColumnRenamed("label", "given"), both["b"] == F.col("node")).drop("node")
            .join(labels, both["a"] == F.col("node")).select("label", "node", "given")
        )
        hooks = offered.groupBy(F.col("label").alias("node")).agg(F.min("given").alias("given")).union(
            offered.groupBy("node").agg(F.min("given").alias("given"))
        ).groupBy("node").agg(F.min("given").alias("given"))
        hooked = stored(labels.join(hooks, "node", "left").select(
            "node", "label", F.least("label", F.coalesce("given", "label")).alias("next")))
        roots = hooked.select(F.col("node").alias("root"), F.col("next").alias("beyond"))
        jumped = stored(
            hooked.join(roots, hooked["next"] == F.col("root"), "left")
            .select("node", F.col("label").alias("old"), F.least("next", F.coalesce("beyond", "next")).alias("label"))
        )
        changed = jumped.filter("old <> label").limit(1).count()
        labels = jumped.select("node", "label")
        if not changed:
            return labels
