"""Connected components by alternating large-star and small-star steps.

Every step is a ``groupBy(min)`` with map-side combine and a join of the
edges with one row per node.  Each step's edges and minima are written to the
shared folder, so both sides of the join are plain shuffles that AQE can
split when a node has very many neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.tables import written


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the undirected ``edges`` (a, b longs);
    label is the smallest node of the component.  Self links and repeats are
    ignored; no edges give no rows."""
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    current = written(edges.where("a <> b").select(high, low).distinct(), "cc-edges")
    before, after = None, _signature(current)
    while after[0] and before != after:
        # large star: every larger neighbour is tied to the smallest neighbour
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).union(current.select("b", "a"))
        least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "cc-large")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "cc-mid")
        # small star: the smaller neighbours and the node itself are tied to the smallest one
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "cc-small")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = written(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "cc-edges")
        before, after = after, _signature(current)
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.union(nodes.select("label", "label").distinct())
