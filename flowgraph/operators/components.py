"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

The smallest id of a component ends up as its label. Only minima are aggregated; a hub's neighbours are never
gathered in one task, and the join that hands the minimum back is broadcast or salted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgraph.plans.sizing import cut, sized_join
from flowgraph.schemas import Graph


def _smallest(pairs: DataFrame) -> DataFrame:
    """Per u the smallest id among u and its partners."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(links: DataFrame, nodes: int) -> DataFrame:
    both = links.select(
        F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")
    ).select("e.u", "e.v")
    joined = sized_join(both, _smallest(both), "u", nodes, spread="v")
    return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame, nodes: int) -> DataFrame:
    """links has u > v."""
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = sized_join(links, low, "u", nodes, spread="v")
    moved = joined.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
    return moved.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()


def _is_stable(links: DataFrame) -> bool:
    """True when every vertex with a link down has exactly one, and none of its links up: separate stars."""
    ends = links.select(
        F.explode(
            F.array(
                F.struct(F.col("u").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("centre")),
                F.struct(F.col("v").alias("n"), F.lit(0).alias("child"), F.lit(1).alias("centre")),
            )
        ).alias("e")
    ).select("e.*")
    roles = ends.groupBy("n").agg(F.sum("child").alias("child"), F.max("centre").alias("centre"))
    return roles.where("child > 1 or (child > 0 and centre > 0)").isEmpty()


def connected_components(graph: Graph, max_rounds: int = 100) -> DataFrame:
    """(node_id, component) for every vertex; edges count in both directions."""
    bound = graph.n_vertices
    links = graph.edges.where("src <> dst").select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    ).distinct()
    for _ in range(max_rounds):
        links = cut(_small_star(_large_star(links, bound), bound))
        if _is_stable(links):
            break
    else:
        raise RuntimeError(f"components not stable after {max_rounds} rounds")
    roots = links.select(F.col("u").alias("node_id"), F.col("v").alias("component"))
    labelled = sized_join(graph.vertices.select("node_id"), roots, "node_id", bound, spread="node_id", how="left")
    return labelled.select("node_id", F.coalesce("component", "node_id").alias("component"))


def component_count(components: DataFrame) -> DataFrame:
    return components.agg(F.countDistinct("component").alias("components"))
