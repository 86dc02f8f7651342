"""Connected components of a graph given as a table of edges, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.plans.scale import written


def _stars(pairs: DataFrame) -> DataFrame:
    """Each node u of the pairs (u, v) with the least of itself and its neighbours."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than u is tied to the least of u's neighbourhood."""
    pairs = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        pairs.join(_stars(pairs), "u").where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("least").alias("v")).where(F.col("u") != F.col("v")).distinct()
    )


def small_star(edges: DataFrame) -> DataFrame:
    """u and every neighbour smaller than u are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_stars(down), "u")
    tied = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).unionAll(
        joined.select("u", F.col("least").alias("v")))
    return tied.where(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component: the least node that can be reached, for every node of an edge.

    Edges with a null end are left out, an edge from a node to itself only names the node, and repeated edges count once.
    No node's neighbours are ever brought together: minima are combined before the shuffle and joined back. Each round is
    written, so a lost executor costs one round; the number of rounds grows with the logarithm of the longest path.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna()
    nodes = written(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    now, before = written(pairs.where(F.col("u") != F.col("v")).distinct()), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before, now = state, written(small_star(large_star(now)))
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("least"))
    return nodes.join(ends, "node", "left").select("node", F.coalesce("least", "node").alias("component"))
