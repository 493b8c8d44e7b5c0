"""Node sets, adjacency, degrees and the matrices built from them, all as sparse rows.

A matrix is an `Operator`: rows `(i, j, w)` with a proven bound on their number. Rows of one (i, j) may repeat;
their weights add up. An anchored operator has at least one row (i, i) per vertex, with a null weight where the
matrix has no diagonal entry, so that `propagate` can carry a node's own columns through the same join.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgraph.functions.scalars import closeness, inverse_sqrt, reciprocal
from flowgraph.plans.sizing import settle, sized_join
from flowgraph.schemas import Graph, endpoints


@dataclass(frozen=True)
class Operator:
    df: DataFrame
    rows: int
    nodes: int
    anchored: bool = False
    # (blk, i, js, ws): the rows of the matrix once per block of steps, partitioned by block (`propagate.dealt`). `flipped` swaps i and j.
    dealt: DataFrame | None = None
    flipped: bool = False

    def transposed(self) -> "Operator":
        return replace(self, df=self.df.select(F.col("j").alias("i"), F.col("i").alias("j"), "w"), flipped=not self.flipped)

    def by_block(self) -> DataFrame:
        """(blk, i, j, w) of a dealt operator; the entries of a row follow each other unless it is flipped."""
        rows = self.dealt.select("blk", "i", F.posexplode("js").alias("_p", "j"), "ws").select("blk", "i", "j", F.get("ws", F.col("_p")).alias("w"))
        return rows.select("blk", F.col("j").alias("i"), F.col("i").alias("j"), "w") if self.flipped else rows

    def anchor(self, graph: Graph) -> "Operator":
        if self.anchored:
            return self
        markers = graph.vertices.select(
            F.col("node_id").alias("i"), F.col("node_id").alias("j"), F.lit(None).cast("double").alias("w")
        )
        return replace(self, df=self.df.unionByName(markers), rows=self.rows + graph.n_vertices, anchored=True, dealt=None, flipped=False)

    def settled(self) -> "Operator":
        s = settle(self.df)
        return replace(self, df=s.df, rows=s.rows, dealt=None, flipped=False)


# --- node sets and id maps -----------------------------------------------------------------------------------

def node_set(edges: DataFrame) -> DataFrame:
    return endpoints(edges).distinct()


def to_dense_ids(edges: DataFrame, order: DataFrame, n_ids: int, unknown: str = "fail") -> DataFrame:
    """Replace raw ids by their dense index from `order` (raw_id, idx); unknown="fail" or "drop"."""
    if unknown not in ("fail", "drop"):
        raise ValueError(f"unknown must be fail or drop, not {unknown!r}")
    if unknown == "fail":
        lost = unknown_ids(edges, order).limit(5).collect()
        if lost:
            raise KeyError(f"ids without an index, for example {[r.node_id for r in lost]}")
    sources = order.select(F.col("raw_id").alias("src"), F.col("idx").alias("_src_idx"))
    targets = order.select(F.col("raw_id").alias("dst"), F.col("idx").alias("_dst_idx"))
    mapped = sized_join(edges, sources, "src", n_ids, spread="dst")
    mapped = sized_join(mapped, targets, "dst", n_ids, spread="src")
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    return mapped.select(F.col("_src_idx").alias("src"), F.col("_dst_idx").alias("dst"), *rest)


def unknown_ids(edges: DataFrame, order: DataFrame) -> DataFrame:
    return node_set(edges).join(order.select(F.col("raw_id").alias("node_id")), "node_id", "left_anti")


# --- adjacency -----------------------------------------------------------------------------------------------

def adjacency(graph: Graph, graph_type: str = "connect", cost: str = "weight") -> Operator:
    """Symmetric adjacency: 1 per connected pair, or 1/cost. Of several costs of a pair the smallest counts."""
    if graph_type not in ("connect", "distance"):
        raise ValueError(f"graph type must be connect or distance, not {graph_type!r}")
    ends = [F.struct(F.col("src").alias("i"), F.col("dst").alias("j")), F.struct(F.col("dst").alias("i"), F.col("src").alias("j"))]
    if graph_type == "connect":
        pairs = graph.edges.select(F.explode(F.array(*ends)).alias("e")).select("e.i", "e.j").distinct()
        pairs = pairs.withColumn("w", F.lit(1.0))
    else:
        pairs = graph.edges.select(F.explode(F.array(*ends)).alias("e"), F.col(cost).alias("c"))
        pairs = pairs.groupBy("e.i", "e.j").agg(F.min("c").alias("c")).select("i", "j", closeness(F.col("c")).alias("w"))
    return Operator(pairs, 2 * graph.n_edges, graph.n_vertices)


def degrees(edges: DataFrame, mode: str = "total") -> DataFrame:
    """Number of edge ends per node, duplicates counted; mode total, in or out."""
    if mode == "total":
        ends = endpoints(edges)
    elif mode in ("in", "out"):
        ends = edges.select(F.col("dst" if mode == "in" else "src").alias("node_id"))
    else:
        raise ValueError(f"degree mode must be total, in or out, not {mode!r}")
    return ends.groupBy("node_id").agg(F.count("*").alias("degree"))


def degree_table(graph: Graph, mode: str = "total") -> DataFrame:
    """Degree and its inverse square root for every vertex, 0 for isolated ones."""
    counted = degrees(graph.edges, mode)
    joined = graph.vertices.select("node_id").join(counted, "node_id", "left")
    degree = F.coalesce("degree", F.lit(0)).cast("bigint")
    return joined.select("node_id", degree.alias("degree"), inverse_sqrt(degree).alias("inv_sqrt_degree"))


def degree_stats(edges: DataFrame, mode: str = "total") -> DataFrame:
    return degrees(edges, mode).agg(
        F.count("degree").alias("count"),
        F.avg("degree").alias("mean"),
        F.stddev_samp("degree").alias("stddev"),
        F.min("degree").alias("min"),
        F.max("degree").alias("max"),
    )


def row_sums(op: Operator) -> DataFrame:
    return op.df.groupBy("i").agg(F.sum("w").alias("d"))


# --- matrices ------------------------------------------------------------------------------------------------

def _scaled_by_nodes(op: Operator, factors: DataFrame, rows: bool, columns: bool) -> DataFrame:
    """op.df with `f_i` and/or `f_j` from factors (node_id, f); rows without a factor are kept with null."""
    df = op.df
    if rows:
        at_i = factors.select(F.col("node_id").alias("i"), F.col("f").alias("f_i"))
        df = sized_join(df, at_i, "i", op.nodes, spread="j", how="left")
    if columns:
        at_j = factors.select(F.col("node_id").alias("j"), F.col("f").alias("f_j"))
        df = sized_join(df, at_j, "j", op.nodes, spread="i", how="left")
    return df


def with_self_loops(op: Operator, graph: Graph) -> Operator:
    """A + I over all vertices."""
    loops = graph.vertices.select(F.col("node_id").alias("i"), F.col("node_id").alias("j"), F.lit(1.0).alias("w"))
    summed = op.df.unionByName(loops).groupBy("i", "j").agg(F.sum("w").alias("w"))
    return Operator(summed, op.rows + graph.n_vertices, graph.n_vertices, anchored=True)


def random_walk(op: Operator, graph: Graph) -> Operator:
    """D^-1 (A + I): every row sums to one."""
    looped = with_self_loops(op, graph)
    factors = row_sums(looped).select(F.col("i").alias("node_id"), reciprocal(F.col("d")).alias("f"))
    walk = _scaled_by_nodes(looped, factors, rows=True, columns=False)
    return replace(looped, df=walk.select("i", "j", (F.col("w") * F.col("f_i")).alias("w")))


def laplacian(op: Operator, graph: Graph, normalize: bool = True) -> Operator:
    """I - D^-1/2 A D^-1/2, or D - A. An isolated vertex keeps the row of the identity, or a zero row."""
    degree = row_sums(op).select(F.col("i").alias("node_id"), F.col("d"))
    corner = graph.vertices.select("node_id")
    if normalize:
        factors = degree.select("node_id", inverse_sqrt(F.col("d")).alias("f"))
        off = _scaled_by_nodes(op, factors, rows=True, columns=True)
        off = off.select("i", "j", (-F.col("w") * F.col("f_i") * F.col("f_j")).alias("w"))
        diagonal = corner.withColumn("w", F.lit(1.0))
    else:
        off = op.df.select("i", "j", (-F.col("w")).alias("w"))
        diagonal = corner.join(degree, "node_id", "left").select("node_id", F.coalesce("d", F.lit(0.0)).alias("w"))
    diagonal = diagonal.select(F.col("node_id").alias("i"), F.col("node_id").alias("j"), "w")
    summed = off.unionByName(diagonal).groupBy("i", "j").agg(F.sum("w").alias("w"))
    return Operator(summed, op.rows + graph.n_vertices, graph.n_vertices, anchored=True)


def directed_normalised(graph: Graph, mode: str = "total") -> Operator:
    """One weight d_src^-1/2 * d_dst^-1/2 per directed edge u -> v, stored as (i=v, j=u). Edge costs play no part."""
    factors = degrees(graph.edges, mode).select("node_id", inverse_sqrt(F.col("degree")).alias("f"))
    plain = Operator(
        graph.edges.select(F.col("dst").alias("i"), F.col("src").alias("j")), graph.n_edges, graph.n_vertices
    )
    both = _scaled_by_nodes(plain, factors, rows=True, columns=True)
    zero = F.lit(0.0)
    weight = F.coalesce("f_i", zero) * F.coalesce("f_j", zero)
    return replace(plain, df=both.select("i", "j", weight.alias("w")))


def plain_edges(graph: Graph) -> Operator:
    """Weight 1 per directed edge, receiver i, sender j."""
    df = graph.edges.select(F.col("dst").alias("i"), F.col("src").alias("j"), F.lit(1.0).alias("w"))
    return Operator(df, graph.n_edges, graph.n_vertices)
