"""Connected components of a graph of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowmart.session import Scratch


def _stars(edges: DataFrame, both: bool) -> DataFrame:
    """Point the neighbours of each node at the smallest one.

    `both`: larger neighbours, over edges in both directions; else smaller ones and the
    node itself. The smallest neighbour comes from an aggregate that combines in the map
    task, so a hub costs no more than its edges, and the join back can split a hub.
    """
    if both:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    least = least.withColumn("least", F.least("a", "least"))
    joined = edges.join(least, "a")
    if both:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(node, component) of every node with a link; a component is named by its smallest node.

    `edges` has long columns a and b, in any order, with repeats or none. Large and small
    stars alternate until the edges stay the same. The result is pinned under `label`.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = scratch.pin(links.distinct(), label)
    seen = None
    while True:
        state = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("mark")
        ).first()
        if seen == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = state
        large = _stars(links, both=True).where("a <> b").distinct()
        small = _stars(large, both=False).where("a <> b").distinct()
        links = scratch.pin(small, label)
