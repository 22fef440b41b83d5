"""Connected components of an undirected graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalgrove.llm.shared import stored


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them. Edges come as u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(
        moved.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v (long). One row per node that has an edge: ``node``, ``root`` (the least node of its component).

    Minima are combined before each shuffle and joined back, so a node with very many edges stays no single
    task's. Each round is stored in the shared scratch folder; rounds grow with the logarithm of the nodes. Null nodes and
    loops are left out; repeated edges count once.
    """
    a, b = F.col("u"), F.col("v")
    edges = stored(edges.where((a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = None
    while (now := _digest(edges)) != before:
        before = now
        edges = stored(_small_star(_large_star(edges)), "edges")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
