"""Forecast plans: neighbour forecast, model scoring, evaluation, and the whole run from readings to saved result."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgraph.operators.graph import Operator, adjacency, directed_normalised, laplacian, random_walk
from flowgraph.operators.layers import ChebParams, GatParams, GcnParams, Params, gat_forward, series_forward
from flowgraph.operators.metrics import value_bounds
from flowgraph.operators.panel import (
    STEP_BLOCK,
    Base,
    block_size,
    fit_base,
    samples,
    scale,
    slice_node,
    split_span,
    unscale,
    with_halo,
    within,
)
from flowgraph.operators.propagate import dealt, propagate
from flowgraph.plans.sizing import Settled, broadcast_rows, settle, sized_join
from flowgraph.schemas import Graph

STEP_LAYOUT_NODES = 1_000_000
# A task of the step layout holds all nodes for a block of steps, so blocks get shorter where the nodes are many, down to LEAST_STEPS:
# the entries of a dealt operator move once per block.
STEP_CELLS = 1_000_000
LEAST_STEPS = 6
# Networks beyond the broadcast bound run inside the blocks and hold a step at a time, so their blocks stay longer and the entries move less often.
NETWORK_CELLS = 16_000_000


@dataclass(frozen=True)
class RunConfig:
    time_interval: int = 5
    h: int = 6
    divide_days: Sequence[int] = (45, 14)
    variant: str = "days"
    n_steps: int | None = None
    fit_on: str = "all"
    constant: str = "null"

    def span(self, mode: str) -> tuple[int, int]:
        return split_span(
            mode, self.divide_days, self.time_interval, self.h, variant=self.variant, n_steps=self.n_steps
        )


def layout_for(graph: Graph) -> str:
    """Blocks of steps with all nodes together while their number is known to be small, else blocks per node. The edges do not
    count: beyond the broadcast bound they are dealt to the blocks (`dealt`)."""
    small = graph.n_vertices <= min(STEP_LAYOUT_NODES, broadcast_rows(graph.edges.sparkSession))
    return "step" if small else "node"


def step_block(graph: Graph, cells: int = STEP_CELLS) -> int:
    """Steps per block of the step layout: about `cells` cells."""
    return max(LEAST_STEPS, min(STEP_BLOCK, cells // max(graph.n_vertices, 1)))


def block_for(graph: Graph, h: int) -> int:
    layout = layout_for(graph)
    return block_size(h, layout, step_block(graph) if layout == "step" else None)


def network_block(graph: Graph, h: int, entries: int | None = None) -> int:
    """The block size for networks: that of `block_for` while the operator may be broadcast. `entries` is the number of its entries, where it is known."""
    entries = 2 * graph.n_edges + graph.n_vertices if entries is None else entries
    if layout_for(graph) == "node" or entries <= broadcast_rows(graph.edges.sparkSession):
        return block_for(graph, h)
    return block_size(h, "step", step_block(graph, NETWORK_CELLS))


def fitted(op: Operator, rows: DataFrame, layout: str, block: int | None = None, always: bool = False) -> Operator:
    """`op` as `propagate` takes it for rows of this layout and block size; `always` dealt in the step layout, as attention takes it."""
    return dealt(op, rows, block, always) if layout == "step" else op


def mean_forecast(panel: DataFrame, h: int, span: tuple[int, int]) -> DataFrame:
    """Prediction = mean of the history."""
    rows = samples(panel, h, span, lags=False, mean=True)
    return rows.select("node_id", "t", F.col("hist_mean").alias("prediction"), F.col("y").alias("target"))


def neighbour_forecast(
    panel: DataFrame, graph: Graph, h: int, span: tuple[int, int], degree_mode: str = "total"
) -> DataFrame:
    """Degree-normalised sum of the senders' history means; the node's own mean where nothing arrives.

    All steps in one plan. With the step layout the readings are shuffled once, by block of steps.
    """
    layout = layout_for(graph)
    rows = samples(panel, h, span, lags=False, mean=True, layout=layout, block=block_for(graph, h))
    return _arrived(rows, fitted(directed_normalised(graph, degree_mode).anchor(graph), rows, layout, block_for(graph, h)))


def _arrived(rows: DataFrame, op: Operator) -> DataFrame:
    arrived = propagate(rows, op, ["hist_mean"], carry=["hist_mean", "y"], out=["arrived"])
    return arrived.select(
        "node_id", "t", F.coalesce("arrived", "hist_mean").alias("prediction"), F.col("y").alias("target")
    )


def operator_for(model: Params, graph: Graph, graph_type: str = "connect") -> Operator:
    symmetric = adjacency(graph, graph_type)
    if isinstance(model, GcnParams):
        return random_walk(symmetric, graph)
    if isinstance(model, ChebParams):
        return laplacian(symmetric, graph, model.normalize)
    return symmetric.anchor(graph)


def score(
    rows: DataFrame, graph: Graph, model: Params, h: int, block: int, column: str = "y", graph_type: str = "connect",
    cut_to: Callable[[DataFrame], DataFrame] = lambda df: df, op: Operator | None = None,
) -> DataFrame:
    """Run the model given by its parameters over `with_halo` rows; adds `prediction`. `op` replaces the graph's operator."""
    op = op or operator_for(model, graph, graph_type).settled()
    if isinstance(model, GatParams):
        return gat_forward(rows, fitted(op, rows, layout_for(graph), block, always=True), model, h, block, column, cut_to, layout_for(graph))
    return series_forward(rows, fitted(op, rows, layout_for(graph), block), model, h, block, column, cut_to)


def model_rows(
    panel: DataFrame, graph: Graph, model: Params, h: int, span: tuple[int, int], block: int | None = None
) -> tuple[DataFrame, int]:
    """The readings a model needs for the target steps in `span`, in blocks, and the block size."""
    layout = layout_for(graph)
    block = block or network_block(graph, h)
    if isinstance(model, GatParams) and layout == "node":
        # Attention packs a block into one row, so its blocks stay short in either layout.
        block = block_size(h, layout, STEP_BLOCK)
    readings = within(panel, span, h).select("t", "node_id", F.col("flow").alias("y"))
    return with_halo(readings, h, layout, block), block


def model_forecast(
    panel: DataFrame, graph: Graph, model: Params, h: int, span: tuple[int, int], graph_type: str = "connect",
    op: Operator | None = None,
) -> DataFrame:
    if not isinstance(model, Params):
        raise ValueError(f"no model for {type(model).__name__}")
    op = op or operator_for(model, graph, graph_type).settled()
    rows, block = model_rows(panel, graph, model, h, span, network_block(graph, h, op.rows))
    scored = score(rows, graph, model, h, block, "y", graph_type, lambda df: within(df, span), op)
    return scored.select("node_id", "t", "prediction", F.col("y").alias("target"))


def restore(forecast: DataFrame, base: Base) -> DataFrame:
    return unscale(forecast, base, ["prediction", "target"])


def run(panel: DataFrame, graph: Graph, config: RunConfig, model: Params | None = None, mode: str = "test") -> DataFrame:
    """Readings to forecast in the unit of the readings. Without a model the neighbour forecast is used."""
    if config.fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be all or train, not {config.fit_on!r}")
    base = fit_base(panel, span=config.span("train") if config.fit_on == "train" else None)
    scaled = scale(panel, base, constant=config.constant)
    span = config.span(mode)
    if model is None:
        forecast = neighbour_forecast(scaled, graph, config.h, span)
    else:
        forecast = model_forecast(scaled, graph, model, config.h, span)
    return restore(forecast, base)


# --- the forecast of some nodes only -----------------------------------------------------------------------------

def hops(model: Params | None) -> int | None:
    """Along how many entries of the operator a reading travels to a prediction; None: from anywhere, as attention falls back
    to the mean over all nodes."""
    if model is None:
        return 1
    if isinstance(model, GatParams):
        return None
    return 2 * model.order if isinstance(model, ChebParams) else 2


def neighbourhood(op: Operator, nodes: DataFrame, steps: int) -> Settled:
    """`nodes` and all that reach them along at most `steps` entries of the operator."""
    near = settle(nodes.select("node_id").distinct())
    for _ in range(steps):
        wanted = near.df.select(F.col("node_id").alias("i"))
        entries = op.df.select("i", F.col("j").alias("node_id"))
        senders = sized_join(entries, wanted, "i", near.rows, spread="node_id", how="left_semi").select("node_id")
        grown = settle(near.df.unionByName(senders).distinct())
        if grown.rows == near.rows:
            break
        near = grown
    return near


def restricted(op: Operator, near: Settled) -> Operator:
    """The entries between nodes of `near`, with the weights they have in the whole graph."""
    rows = sized_join(op.df, near.df.select(F.col("node_id").alias("i")), "i", near.rows, spread="j", how="left_semi")
    both = sized_join(rows, near.df.select(F.col("node_id").alias("j")), "j", near.rows, spread="i", how="left_semi")
    return replace(op, df=both.select("i", "j", "w"))


def node_forecast(
    read: Callable[[Settled, tuple[int, int] | None], DataFrame], graph: Graph, config: RunConfig, nodes: DataFrame,
    span: tuple[int, int], model: Params | None = None,
) -> DataFrame:
    """`run` for the given nodes and target steps, without the rest of the panel.

    The nodes that can reach the wanted ones are found on the graph first, and `read(near, steps)` gives the panel of these
    nodes and steps (all steps: None), so both filters can sit at the scan. Operators keep the weights of the whole graph;
    what is incomplete at the border of the neighbourhood never reaches a wanted node.
    """
    if model is None:
        op = directed_normalised(graph).anchor(graph).settled()
    else:
        op = operator_for(model, graph).settled()
    reach = hops(model)
    near = settle(graph.vertices.select("node_id")) if reach is None else neighbourhood(op, nodes, reach)
    part = op if reach is None else restricted(op, near).settled()
    base = fit_base(read(near, config.span("train") if config.fit_on == "train" else None))
    scaled = scale(read(near, (max(0, span[0] - config.h), span[1])), base, constant=config.constant)
    if model is None:
        layout = layout_for(graph)
        rows = samples(scaled, config.h, span, lags=False, mean=True, layout=layout, block=block_for(graph, config.h))
        forecast = _arrived(rows, fitted(part, rows, layout, block_for(graph, config.h)))
    else:
        forecast = model_forecast(scaled, graph, model, config.h, span, op=part)
    wanted = settle(nodes.select("node_id").distinct())
    return restore(sized_join(forecast, wanted.df, "node_id", wanted.rows, spread="t", how="left_semi"), base)


def plot_series(forecast: DataFrame, node_id: int, span: tuple[int, int]) -> DataFrame:
    return slice_node(forecast, node_id, span, ["prediction", "target"])


def plot_bounds(forecast: DataFrame, node_id: int, span: tuple[int, int]) -> DataFrame:
    return value_bounds(plot_series(forecast, node_id, span))
