"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from knotwork.session import cut_lineage


# Edges of a partition: a small table stays in few partitions, so that its rounds do not write
# a file for each pair of partitions of the session.
PART_EDGES = 100_000


def _smallest(edges: DataFrame, parts: int) -> DataFrame:
    """(u, m): the smallest neighbour of each u.  Cut, so that the join that follows has plain
    exchanges on both sides and a hub's rows can be split."""
    return cut_lineage(edges.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (u, v); the root is the smallest node.

    Rounds grow with the logarithm of the longest chain.  A node's neighbours are never
    gathered: each step is a partial minimum and a join with one row per node.
    """
    edges = cut_lineage(edges.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before, parts = None, 2 + edges.count() // PART_EDGES
    edges = edges.coalesce(parts)
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct())
        before = state
        # Large star: hang every larger neighbour of u on u's smallest neighbour (or u).
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = _smallest(both, parts).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(large.filter("u != v").distinct().coalesce(parts))
        # Small star: hang u and its smaller neighbours on the smallest of them.
        least = _smallest(large, parts)
        hung = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(hung.union(least.select("u", F.col("m").alias("v"))).distinct().coalesce(parts))
