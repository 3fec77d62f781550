"""Connected components of a graph given by its edges, with joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.sources.scratch import stored


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that an edge ties to another; a component is named by its smallest node.

    Each round a node takes the smallest label around it and then its label's own label,
    so what is known travels twice as far every round. Labels are written each round; the
    driver sees whether any changed. Edges with a NULL end and loops are ignored.
    """
    there = edges.where(f"{a} IS NOT NULL AND {b} IS NOT NULL AND {a} <> {b}")
    ways = [there.select(F.col(x).alias("node"), F.col(y).alias("other")) for x, y in ((a, b), (b, a))]
    both = stored(ways[0].unionByName(ways[1]).distinct(), "edges")
    labels = both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("label"))
    labels = stored(labels, "labels")
    while True:
        near = labels.select(F.col("node").alias("other"), F.col("label").alias("near"))
        around = both.join(near, "other").groupBy("node").agg(F.min("near").alias("near"))
        nearer = labels.join(around, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        roots = nearer.select(F.col("node").alias("label"), F.col("label").alias("root"))
        moved = F.col("root") < F.col("was")
        now = stored(nearer.join(roots, "label").select("node", F.col("root").alias("label"), moved.alias("moved")), "labels")
        labels = now.drop("moved")
        if not now.where("moved").head(1):
            return labels.select("node", F.col("label").alias("component"))
