"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the node's smallest neighbour."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node of its component.

    Each round is two joins over the links and ends in a checkpoint; rounds go with the logarithm of
    the longest chain. Links never leave the executors; only a count does.
    """
    links = cut_lineage(links.select("a", "b").filter("a <> b").distinct())
    while True:
        starred = cut_lineage(_small_star(_large_star(links)))
        moved = starred.exceptAll(links).limit(1).count()
        links = starred
        if not moved:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
