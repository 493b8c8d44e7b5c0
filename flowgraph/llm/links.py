"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgraph.llm.common import stored


def components(links: DataFrame, a: str, b: str, most_rounds: int = 60) -> DataFrame:
    """node, comp: every node of a link and the smallest node it can reach.

    Each round links every node's larger neighbours to its smallest one, then its smaller ones likewise; rows never grow
    beyond the links, no node's neighbours are collected, and the number of rounds grows with the logarithm of the size.
    Each round is written to the shared folder.
    """
    edges = stored(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # large star: larger neighbours of u go to the smallest of u and its neighbours
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "large")
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        new, old = after.count(), edges.count()
        if new == old and after.exceptAll(edges).isEmpty():
            found = after.select(F.col("u").alias("node"), F.col("v").alias("comp"))
            return found.unionByName(after.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
        edges = after
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")
