"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored

#: Rounds after which something must be wrong: each at least halves the distance to a component's least node.
MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``links`` (a, b); a component is named by its least node.

    Alternating star contraction: links of a node to larger ones move to its least neighbour, then those to smaller
    ones. A hub costs one row per link in each round; minima are pre-aggregated before each shuffle, and the joins are
    ones that Spark can split. Only a count and a sum per round reach the driver.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = stored(moved.select("e.*").where("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.col("u").cast("decimal(38,0)")),
                        F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
