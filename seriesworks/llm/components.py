"""Connected components of an undirected graph, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; every result row points to a smaller node."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links of comparable nodes -> (node, root), root being the smallest node reachable.

    Only nodes with a link to another node are returned.  Steps repeat until the links
    no longer change, which takes about the logarithm of the number of nodes; each
    step's links, never more than before, are written to the shared folder.
    """
    now = cut_lineage(edges.filter("u <> v").distinct())
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or seen[0] == 0:
            break
        mark, now = seen, cut_lineage(_stars(now))
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
