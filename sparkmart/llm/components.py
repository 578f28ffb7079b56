"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.session import settle


def _state(edges: DataFrame) -> tuple:
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), mark).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected edges ``u, v``; the root is the smallest node.

    Large stars hang all larger neighbours of a node on its smallest neighbour, small stars do so with
    the smaller ones and the node itself; both keep components together, and their alternation ends in
    one star per component after about log squared rounds. A node's smallest neighbour is an aggregate, so a
    hub is summed before the exchange, and the joins back on it are split where skewed.
    """
    edges = settle(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    before, now = None, _state(edges)
    while now != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = settle(small, "small-star")
        before, now = now, _state(edges)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
