"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Each round points the neighbours of a node at the smallest of them; the number of rounds
    grows with the logarithm of the longest path.  Nothing of a component is gathered in one
    place: minima are aggregated before the shuffle, and joins carry one row per link.
    Links to itself and repeated links are allowed; null ends are not.
    """
    links = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )
    last = None
    while (now := _fingerprint(links)) != last:
        last = now
        both = links.union(links.select("b", "a"))
        # Minima are written, so that the joins with them can split the partition of a node
        # with very many links.
        smallest = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")))
        large = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Every node keeps its link to the smallest: those above point at m, the node itself too.
        large = large.union(smallest.where("a <> m").select("a", F.col("m").alias("b"))).distinct()
        low = written(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(small.union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
