"""Connected components of a link table, with every step distributed and stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that links lead to, for every node of links(a, b), by alternating large and small
    stars (Kiveris et al. 2014): rounds grow with the logarithm of the longest path.

    Each round only groups by node to find minima (summed up in each task first) and joins them back, so a node with very many
    links is no group in any task. Self links and repeated links do no harm; no links give no rows."""
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(most_rounds):
        # Large star: every neighbour above a node is linked to the smallest node around it.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: every neighbour below a node, and the node, are linked to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        edges = stored(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
