"""Connected components of an undirected graph, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import salted_join


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node it reaches.

    Alternating star steps: the large step links each node's larger neighbours to its smallest one, the
    small step its smaller ones; both keep the components, and stars remain after about log(n) rounds. Only
    edge counts and one checksum reach the driver. The minima are aggregates with map-side combine and
    return by a salted join, so a node with a third of all links stays split. Loops and repeated
    edges do nothing.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    before = None
    while True:
        large = _step(links, both_ways=True)
        links = _step(large, both_ways=False).checkpoint()
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _step(links: DataFrame, both_ways: bool) -> DataFrame:
    """Link neighbours of each node to its smallest neighbour (itself included); a > b in all links."""
    near = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if both_ways:
        near = near.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    least = near.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))
    moved = salted_join(near, least, ["node"], "other")
    if both_ways:  # larger neighbours go to the smallest, the node itself stays linked to it by its own edge
        out = moved.where("other > node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    else:
        out = moved.where("other <> least").select(F.col("other").alias("a"), F.col("least").alias("b"))
        out = out.unionByName(least.where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")))
    return out.where("a <> b").distinct()
