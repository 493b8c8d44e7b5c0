"""Row layouts shared by all modules, and the graph handle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.plans.sizing import settle

# Column names of the edge file, fixed by its header.
EDGE_FILE_SCHEMA = T.StructType(
    [
        T.StructField("from", T.LongType()),
        T.StructField("to", T.LongType()),
        T.StructField("cost", T.DoubleType()),
    ]
)

EDGE_SCHEMA = T.StructType(
    [
        T.StructField("src", T.LongType(), False),
        T.StructField("dst", T.LongType(), False),
        T.StructField("weight", T.DoubleType()),
    ]
)

# Edges between named places; further payload columns may follow.
NAMED_EDGE_SCHEMA = T.StructType(
    [
        T.StructField("src", T.StringType(), False),
        T.StructField("dst", T.StringType(), False),
        T.StructField("road_name", T.StringType()),
    ]
)

NAMED_VERTEX_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.StringType(), False),
        T.StructField("description", T.StringType()),
    ]
)

TIMED_READING_SCHEMA = T.StructType(
    [
        T.StructField("src", T.StringType(), False),
        T.StructField("hour", T.IntegerType(), False),
        T.StructField("timestamp", T.StringType()),
        T.StructField("flow", T.DoubleType(), False),
    ]
)

# Fixed value: the three measures of a sensor, in the order they have in an array file.
FEATURES = ("flow", "occupy", "speed")

PANEL_SCHEMA = T.StructType(
    [T.StructField("node_id", T.LongType(), False), T.StructField("t", T.LongType(), False)]
    + [T.StructField(name, T.DoubleType()) for name in FEATURES]
)

FORECAST_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.LongType(), False),
        T.StructField("t", T.LongType(), False),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("target", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Graph:
    """Vertices `node_id[, ...]` and directed edges `src, dst[, ...]`, both settled, so their sizes are known."""

    vertices: DataFrame
    edges: DataFrame
    n_vertices: int
    n_edges: int

    @classmethod
    def of(cls, vertices: DataFrame, edges: DataFrame, check: bool = False) -> "Graph":
        v, e = settle(vertices), settle(edges)
        graph = cls(v.df, e.df, v.rows, e.rows)
        if check:
            lost = graph.dangling().limit(5).collect()
            if lost:
                raise ValueError(f"edges point at unknown vertices, for example {[r.node_id for r in lost]}")
        return graph

    @classmethod
    def of_edges(cls, edges: DataFrame) -> "Graph":
        """A graph whose vertices are the endpoints of its edges."""
        e = settle(edges)
        v = settle(endpoints(e.df).distinct())
        return cls(v.df, e.df, v.rows, e.rows)

    def dangling(self) -> DataFrame:
        """Endpoints that are not in the vertex list."""
        return endpoints(self.edges).distinct().join(self.vertices.select("node_id"), "node_id", "left_anti")

    def with_vertices(self, vertices: DataFrame) -> "Graph":
        v = settle(vertices)
        return Graph(v.df, self.edges, v.rows, self.n_edges)

    def counts(self) -> DataFrame:
        spark = self.vertices.sparkSession
        return spark.createDataFrame(
            [(self.n_vertices, self.n_edges)], "vertices bigint, edges bigint"
        )


def endpoints(edges: DataFrame) -> DataFrame:
    """Both ends of every edge as one `node_id` column, duplicates kept; one pass over the edges."""
    return edges.select(F.explode(F.array("src", "dst")).alias("node_id"))
