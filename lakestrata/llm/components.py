"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star links each node's larger neighbours to its least one; small star the others."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        joined = both.join(least, "u").where("v > u")
        return joined.select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node with a link; root: the least node of its component.

    Rounds grow with the logarithm of the longest path; each ends in the
    shared checkpoint folder.  Null ends and links of a node to itself are
    ignored.
    """
    edges = cut(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = None
    for _ in range(MAX_ROUNDS):
        edges = cut(_star(_star(edges, True).distinct(), False).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
