"""Connected components of a graph given by edges, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.llm.blocks import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (or the node itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node of an edge between different nodes; the component is its smallest node.

    Alternates two steps that only shorten paths to the smallest node, a logarithmic
    number of times; each round is written to the shared folder. Edges with a NULL
    end and loops are ignored. Hubs are grouped map-side before they shuffle, and
    joins on them are plain equi-joins that Spark can split.
    """
    least, most = F.least(a, b), F.greatest(a, b)
    now = edges.where(f"{a} IS NOT NULL AND {b} IS NOT NULL AND {a} <> {b}")
    now = stored(now.select(most.alias("u"), least.alias("v")).distinct(), "edges")
    before = None
    while True:
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or state[0] == 0:
            break
        before = state
        now = stored(_small_star(_large_star(now)), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
