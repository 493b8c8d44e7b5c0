"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgraph.functions import scalars as S
from flowgraph.operators import components as C
from flowgraph.operators import graph as G
from flowgraph.operators import layers as L
from flowgraph.operators import metrics as M
from flowgraph.operators import panel as P
from flowgraph.operators import propagate as R
from flowgraph.plans import driver_tables as D
from flowgraph.plans import forecast as FC
from flowgraph.plans import train as TR
from flowgraph.plans.sizing import settle, shared_path, sized_join
from flowgraph.queries import weights as W
from flowgraph.sources import arrays as SA
from flowgraph.sources import edges as SE
from flowgraph.sources import forecasts as SF

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

TRAIN = P.split_span("train", D.DIVIDE_DAYS, D.TIME_INTERVAL, D.H)
TEST = P.split_span("test", D.DIVIDE_DAYS, D.TIME_INTERVAL, D.H)
CONFIG = FC.RunConfig(D.TIME_INTERVAL, D.H, D.DIVIDE_DAYS)
SEED, EPOCH = 7, 1
PLOT_SPAN = (0, 48)
FIRST_K = 5
ARRAY_STEPS = 240
LAGS = P.lag_names(D.H)


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Round, and turn -0.0 into 0.0."""
    return df.select(*[(F.round(c, digits) + F.lit(0.0)).alias(c) if c in columns else F.col(c) for c in df.columns])


def operator_rows(op: G.Operator) -> DataFrame:
    summed = op.df.groupBy("i", "j").agg(F.sum("w").alias("w"))
    return rounded(summed, ["w"])


def scaled_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = D.panel(spark, sf_dir)
    return P.scale(panel, P.fit_base(panel))


def every_step(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    return D.H, D.calendar(spark, sf_dir).n_steps


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FC.run(D.panel(spark, sf_dir), D.road_graph(spark, sf_dir), CONFIG)


# --- edges and node sets -------------------------------------------------------------------------------------

@query
def edge_projection(spark, sf_dir):
    raw = D.edge_list(spark, sf_dir).select(
        F.col("src").cast("string").alias("from"), F.col("dst").cast("string").alias("to"), F.col("weight").cast("string").alias("cost")
    )
    return rounded(SE.edge_columns(raw), ["weight"])


@query
def edge_csv_source(spark, sf_dir):
    path = shared_path(spark, "edges")
    D.edge_list(spark, sf_dir).select(
        F.col("src").alias("from"), F.col("dst").alias("to"), F.col("weight").alias("cost")
    ).write.option("header", True).csv(path)
    return rounded(SE.read_edges(spark, path), ["weight"])


@query
def edge_csv_rejects(spark, sf_dir):
    """Each edge is written as one good line and as a line of each bad kind; all are read back with what became of them."""
    path = shared_path(spark, "edges")
    a, b, n = (F.col(c).cast("string") for c in ("src", "dst", "n"))
    lines = F.array(
        F.concat_ws(",", a, b, n), F.concat(F.lit('"'), a, F.lit('","'), b, F.lit('",'), n, F.lit(".5")), F.concat_ws(",", a, b),
        F.concat_ws(",", a, F.lit("x"), n), F.concat_ws(",", a, b, n, F.lit("9")), F.concat_ws(",", a, b, F.lit("NaN")),
        F.concat_ws(",", a, F.lit(""), n), F.concat_ws(",", a, b, F.lit("Inf")),
    )
    body = D.edge_list(spark, sf_dir).select(F.explode(lines).alias("from,to,cost"))
    body.write.option("header", True).option("quote", "").option("escapeQuotes", False).option("sep", "\u0001").csv(path)
    checked = SE.checked_edges(spark, path)
    good = checked.good.select("src", "dst", "weight", F.lit("good").alias("reason"), F.lit(None).cast("string").alias("row"))
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("src", "bigint"), ("dst", "bigint"), ("weight", "double"))]
    return good.unionByName(checked.rejected.select(*empty, "reason", "row"))


@query
def node_set(spark, sf_dir):
    return G.node_set(D.edge_list(spark, sf_dir))


@query
def id_remap(spark, sf_dir):
    graph = D.road_graph(spark, sf_dir)
    path = shared_path(spark, "order")
    graph.vertices.orderBy("node_id").select(F.col("node_id").cast("string").alias("value")).write.text(path)
    order = SE.read_node_order(spark, path)
    mapped = G.to_dense_ids(graph.edges.select("src", "dst", "weight"), order, graph.n_vertices)
    return rounded(mapped, ["weight"])


@query
def unknown_ids(spark, sf_dir):
    recurring = D.recurring_graph(spark, sf_dir)
    order = G.node_set(recurring.edges).select(F.col("node_id").alias("raw_id"))
    return G.unknown_ids(D.edge_list(spark, sf_dir), order)


# --- adjacency, degrees, matrices ----------------------------------------------------------------------------

@query
def adjacency_connect(spark, sf_dir):
    return operator_rows(G.adjacency(D.road_graph(spark, sf_dir), "connect"))


@query
def adjacency_distance(spark, sf_dir):
    return operator_rows(G.adjacency(D.road_graph(spark, sf_dir), "distance"))


@query
def degree_total(spark, sf_dir):
    return rounded(G.degree_table(D.recurring_graph(spark, sf_dir)), ["inv_sqrt_degree"])


@query
def degree_in(spark, sf_dir):
    return rounded(G.degree_table(D.road_graph(spark, sf_dir), "in"), ["inv_sqrt_degree"])


@query
def degree_weighted(spark, sf_dir):
    graph = D.road_graph(spark, sf_dir)
    looped = G.with_self_loops(G.adjacency(graph, "distance"), graph)
    return rounded(G.row_sums(looped), ["d"])


@query
def degree_stats(spark, sf_dir):
    return rounded(G.degree_stats(D.edge_list(spark, sf_dir)), ["mean", "stddev"])


@query
def graph_counts(spark, sf_dir):
    return D.road_graph(spark, sf_dir).counts()


def _matrix_query(name: str, source: Query, build: Callable) -> None:
    def run(spark, sf_dir):
        graph = source(spark, sf_dir)
        return operator_rows(build(G.adjacency(graph), graph))

    REGISTRY[name] = run


for _suffix, _source in (("", D.road_graph), ("_recurring", D.recurring_graph)):
    _matrix_query(f"self_loops{_suffix}", _source, G.with_self_loops)
    _matrix_query(f"random_walk{_suffix}", _source, G.random_walk)
    _matrix_query(f"laplacian_norm{_suffix}", _source, G.laplacian)
    _matrix_query(f"laplacian_unnorm{_suffix}", _source, lambda a, g: G.laplacian(a, g, normalize=False))


@query
def components(spark, sf_dir):
    return C.connected_components(D.road_graph(spark, sf_dir))


@query
def components_recurring(spark, sf_dir):
    return C.connected_components(D.recurring_graph(spark, sf_dir))


@query
def component_count(spark, sf_dir):
    return C.component_count(C.connected_components(D.recurring_graph(spark, sf_dir)))


# --- panel ---------------------------------------------------------------------------------------------------

@query
def dense_panel(spark, sf_dir):
    return D.panel(spark, sf_dir)


@query
def node_average(spark, sf_dir):
    return rounded(D.panel(spark, sf_dir).groupBy("node_id").agg(F.avg("flow").alias("features")), ["features"])


@query
def node_average_join(spark, sf_dir):
    graph = D.road_graph(spark, sf_dir)
    averages = D.panel(spark, sf_dir).groupBy(F.col("node_id").alias("src")).agg(F.avg("flow").alias("features"))
    described = graph.vertices.withColumn("description", F.concat(F.lit("Sensor "), F.col("node_id").cast("string")))
    joined = described.join(averages, described.node_id == averages.src)
    return rounded(joined.select("node_id", "description", "features"), ["features"])


@query
def minmax_base(spark, sf_dir):
    return P.base_table(D.panel(spark, sf_dir))


@query
def minmax_base_train(spark, sf_dir):
    return P.base_table(D.panel(spark, sf_dir), span=(0, TRAIN[1]))


@query
def minmax_scale(spark, sf_dir):
    return rounded(scaled_panel(spark, sf_dir), ["flow"])


@query
def minmax_inverse(spark, sf_dir):
    panel = D.panel(spark, sf_dir)
    base = P.fit_base(panel)
    return rounded(P.unscale(P.scale(panel, base), base, ["flow"]), ["flow"])


@query
def panel_shape(spark, sf_dir):
    return P.panel_shape(D.panel(spark, sf_dir))


def _array_folder(spark, sf_dir):
    """The panel as array files, flow and load = flow + 10 t, with the node order file beside them."""
    days, nodes = D.calendar(spark, sf_dir), D.sensors(spark, sf_dir)
    order_path, path = shared_path(spark, "order"), shared_path(spark, "arrays")
    nodes.orderBy("node_id").select(F.col("node_id").cast("string").alias("value")).write.text(order_path)
    order = settle(SE.read_node_order(spark, order_path))
    panel = D.panel(spark, sf_dir).withColumnRenamed("node_id", "raw_id").withColumn("load", F.col("flow") + F.col("t") * 10)
    dense = sized_join(panel, order.df, "raw_id", order.rows, spread="t").select(F.col("idx").alias("node_id"), "t", "flow", "load")
    SA.write_arrays(dense, path, order.rows, days.n_steps, ARRAY_STEPS)
    return path, order, days.n_steps


def _raw_ids(rows, order):
    named = order.df.select(F.col("idx").alias("node_id"), "raw_id")
    joined = sized_join(rows, named, "node_id", order.rows, spread="t")
    return joined.select(F.col("raw_id").alias("node_id"), *rows.columns[1:])


@query
def array_source(spark, sf_dir):
    path, order, _ = _array_folder(spark, sf_dir)
    return _raw_ids(SA.read_arrays(spark, path, features=["flow", "load"], steps_per_task=ARRAY_STEPS // 4), order)


@query
def array_source_span(spark, sf_dir):
    """One feature of the last third of the steps; the other ranges are not opened."""
    path, order, n_steps = _array_folder(spark, sf_dir)
    rows = SA.read_arrays(
        spark, path, features=["flow", "load"], columns=["load"], span=(n_steps - n_steps // 3, n_steps), steps_per_task=ARRAY_STEPS // 4
    )
    return _raw_ids(rows, order)


@query
def feature_select(spark, sf_dir):
    return rounded(P.single_feature(D.feature_panel(spark, sf_dir), "speed", "flow"), ["flow"])


@query
def feature_profile(spark, sf_dir):
    profile = P.feature_profile(D.feature_panel(spark, sf_dir))
    return rounded(profile, ["mean", "stddev", "low", "high", "variation"])


@query
def history_windows(spark, sf_dir):
    return rounded(P.history(scaled_panel(spark, sf_dir), D.H), ["y", *LAGS])


@query
def history_windows_gappy(spark, sf_dir):
    """Windows over the hours that have readings only: a missing hour is null."""
    panel = P.single_feature(D.feature_panel(spark, sf_dir))
    wide = P.history(panel, D.H, mean=True, dense=False, complete_only=False)
    return rounded(wide, ["hist_mean"])


@query
def history_mean(spark, sf_dir):
    return rounded(P.history(scaled_panel(spark, sf_dir), D.H, lags=False, mean=True), ["hist_mean", "y"])


@query
def incomplete_windows(spark, sf_dir):
    return P.incomplete_windows(D.panel(spark, sf_dir), D.H)


def _split_counts(panel: DataFrame, train: tuple[int, int], test: tuple[int, int]) -> DataFrame:
    label = P.split_label(F.col("t"), train, test).alias("split")
    windows = P.history(panel, D.H, lags=False).select("t", label).where("split is not null")
    per_step = windows.groupBy("split", "t").agg(F.count("*").alias("n"))
    return per_step.groupBy("split").agg(
        F.count("*").alias("samples"), F.sum("n").cast("bigint").alias("cells"), F.min("t").alias("first_step"), F.max("t").alias("last_step")
    )


@query
def split_counts(spark, sf_dir):
    return _split_counts(D.panel(spark, sf_dir), TRAIN, TEST)


@query
def split_clamped(spark, sf_dir):
    n_steps = D.calendar(spark, sf_dir).n_steps
    spans = [P.split_span(m, D.DIVIDE_DAYS, D.TIME_INTERVAL, D.H, variant="clamped", n_steps=n_steps) for m in ("train", "test")]
    return _split_counts(D.panel(spark, sf_dir), *spans)


@query
def batch_sequential(spark, sf_dir):
    rows = P.samples(D.panel(spark, sf_dir), D.H, TEST, lags=False)
    batch = P.batch_in_order(F.col("t"), TEST[0]).alias("batch_id")
    return rows.groupBy(batch).agg(F.count("*").alias("cells"), F.min("t").alias("first_step"), F.max("t").alias("last_step"))


@query
def batch_shuffled(spark, sf_dir):
    rows = P.samples(D.panel(spark, sf_dir), D.H, TRAIN, lags=False)
    batch = P.batch_shuffled(F.col("t"), TRAIN, SEED, EPOCH).alias("batch_id")
    return rows.groupBy(batch).agg(F.count("*").alias("cells"), F.sum("t").alias("step_sum"))


@query
def series_arrays(spark, sf_dir):
    arrays = P.to_series_arrays(D.panel(spark, sf_dir), ["flow"], S.steps_per_day(D.TIME_INTERVAL))
    return arrays.select(
        "node_id",
        "block",
        F.concat_ws(",", F.transform("steps", lambda t: t.cast("string"))).alias("steps"),
        F.concat_ws(",", F.transform("flow", lambda x: x.cast("bigint").cast("string"))).alias("flow"),
    )


@query
def series_rows(spark, sf_dir):
    arrays = P.to_series_arrays(D.panel(spark, sf_dir), ["flow"], S.steps_per_day(D.TIME_INTERVAL))
    return P.from_series_arrays(arrays, ["flow"])


# --- time ----------------------------------------------------------------------------------------------------

@query
def time_bands(spark, sf_dir):
    events = D.read_table(spark, sf_dir, "events")
    hour = F.hour(F.col("ts").cast("timestamp")).alias("hour")
    return events.groupBy(hour).agg(F.count("*").alias("n"), F.avg("value").alias("mean_value")).select(
        F.col("hour").cast("bigint").alias("hour"),
        S.day_band(F.col("hour")).alias("band"),
        S.band_factor(F.col("hour")).alias("factor"),
        "n",
        (F.round("mean_value", 6) + 0.0).alias("mean_value"),
    )


@query
def seasonal_factor(spark, sf_dir):
    """The node's mean flow times the factor of the hour, for every step."""
    panel = D.panel(spark, sf_dir)
    nodes = settle(panel.groupBy("node_id").agg(F.avg("flow").alias("base_flow")))
    joined = P.sized_join(panel, nodes.df, "node_id", nodes.rows, spread="t")
    factor = S.band_factor(S.hour_of_step(F.col("t"), D.TIME_INTERVAL))
    return rounded(joined.select("node_id", "t", (F.col("base_flow") * factor).alias("seasonal")), ["seasonal"])


@query
def step_timestamps(spark, sf_dir):
    events = D.read_table(spark, sf_dir, "events")
    start = D.calendar(spark, sf_dir).start
    step = S.step_of(F.col("ts"), start, D.TIME_INTERVAL)
    text = S.formatted_time(S.time_of_step(F.col("t"), start, D.TIME_INTERVAL))
    return events.select("event_id", step.alias("t")).select(
        "event_id",
        "t",
        S.hour_of_step(F.col("t"), D.TIME_INTERVAL).alias("hour"),
        text.alias("step_start"),
        S.step_of(S.parsed_time(text), start, D.TIME_INTERVAL).alias("t_again"),
    )


# --- propagation ---------------------------------------------------------------------------------------------

def _average_features(spark, sf_dir):
    return D.panel(spark, sf_dir).groupBy("node_id").agg(F.avg("flow").alias("features"))


@query
def message_sum(spark, sf_dir):
    sent = R.send_messages(D.road_graph(spark, sf_dir), _average_features(spark, sf_dir), "features")
    return rounded(sent, ["message"])


@query
def message_max(spark, sf_dir):
    sent = R.send_messages(D.road_graph(spark, sf_dir), _average_features(spark, sf_dir), "features", combine=F.max)
    return rounded(sent, ["message"])


def _rounds_query(name: str, source: Query, null_mode: str) -> None:
    def run(spark, sf_dir):
        done = R.additive_rounds(source(spark, sf_dir), _average_features(spark, sf_dir), "features", 3, null_mode)
        return rounded(done, ["features"])

    REGISTRY[name] = run


_rounds_query("additive_rounds_3", D.road_graph, "propagate")
_rounds_query("additive_rounds_3_recurring", D.recurring_graph, "propagate")
_rounds_query("additive_rounds_3_zero", D.recurring_graph, "zero")


@query
def gcn_directed_all_snapshots(spark, sf_dir):
    graph = D.road_graph(spark, sf_dir)
    rows = P.history(scaled_panel(spark, sf_dir), D.H, lags=False, mean=True, layout=FC.layout_for(graph), block=FC.block_for(graph, D.H))
    out = R.directed_convolution(rows, graph, ["hist_mean"], block=FC.block_for(graph, D.H))
    return rounded(out.select("node_id", "t", F.col("hist_mean").alias("gcn_output")), ["gcn_output"], 8)


@query
def spmm(spark, sf_dir):
    """Random-walk operator times the scaled panel."""
    graph = D.road_graph(spark, sf_dir)
    op = G.random_walk(G.adjacency(graph), graph)
    layout = FC.layout_for(graph)
    rows = P.with_halo(scaled_panel(spark, sf_dir), 0, layout, FC.block_for(graph, 0))
    spread = R.propagate(rows, FC.fitted(op, rows, layout, FC.block_for(graph, 0)), ["flow"])
    return rounded(spread.select("node_id", "t", "flow"), ["flow"], 8)


@query
def spmm_hub(spark, sf_dir):
    """The edges, one sender leading to all nodes among them, times the scaled panel, by the shuffle that deals the entries of heavy
    senders apart."""
    graph = D.hub_graph(spark, sf_dir)
    rows = P.with_halo(scaled_panel(spark, sf_dir), 0, "node")
    spread = R.propagate(rows, R.plain_edges(graph), ["flow"], way="split", heavy=64)
    return rounded(spread.select("node_id", "t", "flow"), ["flow"], 8)


@query
def cheb_basis(spark, sf_dir):
    graph = D.road_graph(spark, sf_dir)
    op = G.laplacian(G.adjacency(graph), graph)
    layout = FC.layout_for(graph)
    rows = P.with_halo(scaled_panel(spark, sf_dir), 0, layout, FC.network_block(graph, 0))
    basis = R.chebyshev_basis(rows, FC.fitted(op, rows, layout, FC.network_block(graph, 0)), ["flow"], 3)
    columns = [f"flow_k{k}" for k in range(4)]
    return rounded(basis.select("node_id", "t", *columns), columns)


# --- network scoring -----------------------------------------------------------------------------------------

def _scored(spark, sf_dir, params):
    graph = D.road_graph(spark, sf_dir)
    out = FC.model_forecast(scaled_panel(spark, sf_dir), graph, params, D.H, every_step(spark, sf_dir))
    return rounded(out, ["prediction", "target"])


@query
def gcn_layers(spark, sf_dir):
    """The two convolution layers applied to the cut history windows."""
    graph = D.road_graph(spark, sf_dir)
    layout = FC.layout_for(graph)
    rows = P.samples(scaled_panel(spark, sf_dir), D.H, every_step(spark, sf_dir), layout=layout, block=FC.network_block(graph, D.H))
    op = FC.fitted(FC.operator_for(W.gcn(), graph), rows, layout, FC.network_block(graph, D.H))
    out = L.gcn_forward(rows, op, W.gcn(), LAGS, carry=["y"])
    return rounded(out.select("node_id", "t", "prediction", F.col("y").alias("target")), ["prediction", "target"])


@query
def cheb_layers(spark, sf_dir):
    graph = D.road_graph(spark, sf_dir)
    layout = FC.layout_for(graph)
    rows = P.samples(scaled_panel(spark, sf_dir), D.H, every_step(spark, sf_dir), layout=layout, block=FC.network_block(graph, D.H))
    op = FC.fitted(FC.operator_for(W.cheb(), graph), rows, layout, FC.network_block(graph, D.H))
    out = L.cheb_forward(rows, op, W.cheb(), LAGS, carry=["y"])
    return rounded(out.select("node_id", "t", "prediction", F.col("y").alias("target")), ["prediction", "target"])


@query
def gcn_score(spark, sf_dir):
    return _scored(spark, sf_dir, W.gcn())


@query
def cheb_score(spark, sf_dir):
    return _scored(spark, sf_dir, W.cheb())


@query
def gat_score(spark, sf_dir):
    return _scored(spark, sf_dir, W.gat())


@query
def gat_score_shifted(spark, sf_dir):
    """Unscaled readings plus one, on the sparse graph: isolated nodes, and no all-zero history."""
    graph = D.recurring_graph(spark, sf_dir)
    panel = D.panel(spark, sf_dir).withColumn("flow", F.col("flow") + 1.0)
    return rounded(FC.model_forecast(panel, graph, W.gat(), D.H, every_step(spark, sf_dir)), ["prediction", "target"])


def _first_pairs(spark, sf_dir):
    graph = D.road_graph(spark, sf_dir)
    rows, block = FC.model_rows(scaled_panel(spark, sf_dir), graph, W.gat(), D.H, every_step(spark, sf_dir))
    heads = L.Heads(W.gat().heads, D.H, block)
    op = FC.fitted(G.adjacency(graph, "distance").anchor(graph), rows, FC.layout_for(graph), block, always=True)
    return L.attention_pairs(L.packed(rows, "y"), op, heads), heads


@query
def gat_scores(spark, sf_dir):
    """Attention scores of the first layer, weighted by 1/cost, summed up per node pair over all steps."""
    pairs, _ = _first_pairs(spark, sf_dir)
    totals = L.pair_totals(pairs, ["s_1", "s_2"])
    live = totals.select("i", "j", F.col("live_s_1").alias("live_1"), "s_1", F.col("live_s_2").alias("live_2"), "s_2")
    return rounded(live.where("live_1 > 0 or live_2 > 0"), ["s_1", "s_2"])


@query
def gat_softmax(spark, sf_dir):
    """Attention weights of the first layer, summed up per node pair over all steps."""
    shares = L.attention_weights(*_first_pairs(spark, sf_dir))
    live = L.pair_totals(shares, ["alpha_1", "alpha_2"]).select("i", "j", "alpha_1", "alpha_2")
    return rounded(live.where("alpha_1 is not null or alpha_2 is not null"), ["alpha_1", "alpha_2"])


# --- forecast and metrics ------------------------------------------------------------------------------------

@query
def neighbour_forecast(spark, sf_dir):
    return rounded(forecast(spark, sf_dir), ["prediction", "target"])


@query
def forecast_metrics(spark, sf_dir):
    return rounded(M.metrics(forecast(spark, sf_dir)), ["mae", "mape", "rmse"])


@query
def mean_forecast_metrics(spark, sf_dir):
    panel = D.panel(spark, sf_dir)
    base = P.fit_base(panel)
    out = FC.restore(FC.mean_forecast(P.scale(panel, base), D.H, TEST), base)
    return rounded(M.metrics(out), ["mae", "mape", "rmse"])


@query
def model_metrics(spark, sf_dir):
    """The network with fixed weights, scored on the test part in the unit of the readings."""
    out = FC.run(D.panel(spark, sf_dir), D.road_graph(spark, sf_dir), CONFIG, W.gcn())
    return rounded(M.metrics(out), ["mae", "mape", "rmse"])


@query
def batch_metrics(spark, sf_dir):
    return rounded(M.batch_metrics(forecast(spark, sf_dir), TEST[0]), ["mae", "mape", "rmse"])


@query
def mean_batch_metrics(spark, sf_dir):
    return rounded(M.mean_batch_metrics(forecast(spark, sf_dir), TEST[0]), ["mae", "mape", "rmse"])


def _scaled_forecast(spark, sf_dir):
    return FC.neighbour_forecast(scaled_panel(spark, sf_dir), D.road_graph(spark, sf_dir), D.H, TEST)


@query
def running_loss(spark, sf_dir):
    losses = M.batch_loss(_scaled_forecast(spark, sf_dir), P.batch_in_order(F.col("t"), TEST[0]))
    return rounded(M.running_loss(losses, TEST[1] - TEST[0]), ["mse", "loss"], 8)


@query
def epoch_loss(spark, sf_dir):
    """Loss of one pass over the train part in shuffled batches."""
    graph = D.road_graph(spark, sf_dir)
    out = FC.neighbour_forecast(scaled_panel(spark, sf_dir), graph, D.H, TRAIN)
    losses = M.batch_loss(out, P.batch_shuffled(F.col("t"), TRAIN, SEED, EPOCH))
    return rounded(M.epoch_loss(losses, TRAIN[1] - TRAIN[0]), ["loss"], 8)


@query
def forecast_roundtrip(spark, sf_dir):
    path = shared_path(spark, "forecast")
    SF.write_forecast(forecast(spark, sf_dir), path)
    return rounded(SF.read_forecast(spark, path, "test"), ["prediction", "target"])


@query
def normalised_roundtrip(spark, sf_dir):
    path = shared_path(spark, "forecast")
    if not SF.save_forecast(_scaled_forecast(spark, sf_dir), path, denormalise=False):
        raise RuntimeError("forecast not saved")
    return rounded(SF.read_forecast(spark, path, "test"), ["prediction", "target"])


@query
def ordered_output(spark, sf_dir):
    """The forecast in files ordered by node and step, and each row's place in them."""
    path = shared_path(spark, "ordered")
    SF.write_ordered(forecast(spark, sf_dir), path, files=12)
    return rounded(SF.read_ordered(spark, path), ["prediction", "target"])


def _plot_span() -> tuple[int, int]:
    return TEST[0] + PLOT_SPAN[0], TEST[0] + PLOT_SPAN[1]


def _plot_node(spark, sf_dir) -> DataFrame:
    return D.sensors(spark, sf_dir).agg(F.min("node_id").alias("node_id"))


def _node_part(spark, sf_dir, nodes, model=None):
    days = D.calendar(spark, sf_dir)
    read = lambda near, span: D.panel_part(spark, sf_dir, near, span, days)
    return FC.node_forecast(read, D.road_graph(spark, sf_dir), CONFIG, nodes, _plot_span(), model)


@query
def plot_slice(spark, sf_dir):
    node = _plot_node(spark, sf_dir)
    out = FC.plot_series(_node_part(spark, sf_dir, node), node.first()[0], _plot_span())
    return rounded(out, ["prediction", "target"])


@query
def plot_bounds(spark, sf_dir):
    node = _plot_node(spark, sf_dir)
    out = FC.plot_bounds(_node_part(spark, sf_dir, node), node.first()[0], _plot_span())
    return rounded(out, ["low", "high"])


@query
def model_plot_slice(spark, sf_dir):
    """Two layers of the fixed network for one node: its neighbours' neighbours are read."""
    node = _plot_node(spark, sf_dir)
    out = FC.plot_series(_node_part(spark, sf_dir, node, W.gcn()), node.first()[0], _plot_span())
    return rounded(out, ["prediction", "target"])


@query
def first_k_samples(spark, sf_dir):
    return rounded(P.first_samples(forecast(spark, sf_dir), FIRST_K).select("node_id", "t", "prediction"), ["prediction"])


# --- training ------------------------------------------------------------------------------------------------

def _gradient(spark, sf_dir, params):
    graph = D.road_graph(spark, sf_dir)
    op = FC.operator_for(params, graph).settled()
    rows, op = TR.settled_rows(scaled_panel(spark, sf_dir), graph, op, params, D.H, TRAIN)
    sums = TR.filter_gradient(rows, op, params, D.H)
    return rounded(sums, [c for c in sums.columns if c != "part"], 5)


@query
def gcn_loss_gradient(spark, sf_dir):
    return _gradient(spark, sf_dir, W.gcn())


@query
def cheb_loss_gradient(spark, sf_dir):
    return _gradient(spark, sf_dir, W.cheb())


def _trained(spark, sf_dir, params, epochs, rate):
    done = TR.train(
        scaled_panel(spark, sf_dir), D.road_graph(spark, sf_dir), params, D.H, TRAIN, epochs=epochs, batch_steps=None, rate=rate
    )
    return L.parameter_table(spark, done.params)


@query
def gcn_train(spark, sf_dir):
    return _trained(spark, sf_dir, W.gcn(), 3, 0.01)


@query
def cheb_train(spark, sf_dir):
    return _trained(spark, sf_dir, W.cheb(), 2, 0.01)


def _linear_rows(spark, sf_dir):
    graph = D.road_graph(spark, sf_dir)
    params = W.gcn()
    op = FC.operator_for(params, graph).settled()
    return TR.training_rows(scaled_panel(spark, sf_dir), graph, op, params, D.H, TRAIN), TR.input_names(params, D.H)


@query
def sgc_gram(spark, sf_dir):
    sums = TR.gram(*_linear_rows(spark, sf_dir))
    return rounded(sums, [c for c in sums.columns if c != "row"], 5)


@query
def sgc_linear_fit(spark, sf_dir):
    rows, inputs = _linear_rows(spark, sf_dir)
    return rounded(TR.solved(TR.gram(rows, inputs), len(inputs)), ["value"])
