"""Connected components of a graph of links, by alternating large and small stars.

Each round replaces the links of a node by links to its smallest neighbour, until the
links are stars around the smallest node of each component. A round is two joins whose
hot side Spark can split, and its result is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import stored


def components(links: DataFrame, folder: str | None = None) -> DataFrame:
    """(node, root): every node of ``links`` (columns a and b, long) with its smallest peer.

    Links may repeat, run either way or lead back to their node; rows with a null are
    no links. A node without another is its own root.
    """
    nodes = links.where("a IS NOT NULL AND b IS NOT NULL")
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = stored(nodes.select(high, low).distinct(), "links", folder)
    loops = edges.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("root"))
    edges, before = edges.where("u <> v"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        edges = stored(_small_star(_large_star(edges)), "stars", folder)
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    alone = loops.join(edges.select(F.col("u").alias("node")), "node", "left_anti")
    return stars.unionByName(roots).unionByName(alone.join(roots, "node", "left_anti"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).distinct()
