import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_graph import dense, dense_adjacency
from test_panel import frame
from test_plans import exchanges

from flowgraph.operators import graph as G
from flowgraph.operators import layers as L
from flowgraph.operators import panel as P
from flowgraph.plans import forecast as FC
from flowgraph.plans import train as TR

H = 3


def windows_of(x):
    return np.stack([x[:, t - H : t] for t in range(H, x.shape[1])])  # [B, N, H]


def relu(a):
    return np.maximum(a, 0)


def dense_gcn(x, walk, p):
    h = relu(walk @ (windows_of(x) @ np.array(p.weight[0]) + p.bias[0]))
    return relu(walk @ (h @ np.array(p.weight[1]) + p.bias[1]))[..., 0]


def dense_cheb(x, lap, p):
    taps = [np.eye(len(lap)), lap]
    for _ in range(2, p.order + 1):
        taps.append(2 * lap @ taps[-1] - taps[-2])
    value = windows_of(x)
    for w, b in zip(p.weight, p.bias):
        value = relu(sum(t @ value @ np.array(m) for t, m in zip(taps, w)) + (0 if b is None else np.array(b)))
    return value[..., 0]


def dense_attention(h, a, b):
    s = np.einsum("bic,bjc->bij", h, h) * a
    s = np.where(s == 0, -1e16, s)
    e = np.exp(s - s.max(-1, keepdims=True))
    return (e / e.sum(-1, keepdims=True)) @ h + b


def dense_gat(x, a, p):
    def act(v):
        return np.where(v >= 0, v, 0.01 * v)

    w = windows_of(x)
    hidden = act(np.concatenate([dense_attention(w @ np.array(m), a, np.array(b)) for m, b in zip(p.heads, p.head_bias)], -1))
    return act(dense_attention(hidden @ np.array(p.out), a, np.array(p.out_bias)))[..., 0]


@pytest.fixture(scope="module")
def readings():
    x = np.random.default_rng(8).uniform(0, 1, (11, 40))
    x[3, 5:12] = 0.0
    x[[2, 4, 8], 5:12] = 0.0
    return x


def predicted(spark, graph, x, model, graph_type="connect"):
    out = FC.model_forecast(frame(spark, x), graph, model, H, (H, x.shape[1]), graph_type).collect()
    got = np.full((x.shape[1] - H, x.shape[0]), np.nan)
    for r in out:
        got[r.t - H, r.node_id] = r.prediction
        assert r.target == pytest.approx(x[r.node_id, r.t])
    return got


MODELS = {
    "gcn": L.init_gcn(H, 4, 1, seed=1),
    "cheb": L.init_cheb(H, 4, 1, 3, seed=2),
    "gat": L.init_gat(H, 4, 1, 2, seed=3),
}


def dense_out(name, x, graph_type="connect"):
    a = dense_adjacency(11, graph_type == "distance")
    if name == "gat":
        return dense_gat(x, a, MODELS["gat"])
    if name == "gcn":
        looped = a + np.eye(11)
        return dense_gcn(x, looped / looped.sum(1, keepdims=True), MODELS["gcn"])
    d = a.sum(1)
    f = np.where(d > 0, np.where(d > 0, d, 1) ** -0.5, 0)
    return dense_cheb(x, np.eye(11) - f[:, None] * a * f, MODELS["cheb"])


@pytest.mark.parametrize("name", list(MODELS))
def test_networks_match_dense(spark, ten_isolated, readings, name):
    assert np.allclose(predicted(spark, ten_isolated, readings, MODELS[name]), dense_out(name, readings), atol=1e-9)


@pytest.mark.parametrize("name", ["cheb", "gat"])
def test_networks_beyond_the_broadcast_bound(spark, ten_isolated, readings, name):
    spark.conf.set("spark.flowgraph.broadcastRows", "0")
    try:
        assert FC.layout_for(ten_isolated) == "node"
        got = predicted(spark, ten_isolated, readings, MODELS[name], "distance")
        assert np.allclose(got, dense_out(name, readings, "distance"), atol=1e-9)
    finally:
        spark.conf.unset("spark.flowgraph.broadcastRows")


@pytest.mark.parametrize("name", list(MODELS))
def test_operator_beyond_the_bound_is_dealt_to_blocks(spark, ten_isolated, readings, name):
    """Few nodes and many entries: no row travels along an entry, and a block stays in one task."""
    spark.conf.set("spark.flowgraph.broadcastRows", "12")
    try:
        assert FC.layout_for(ten_isolated) == "step"
        out = FC.model_forecast(frame(spark, readings), ten_isolated, MODELS[name], H, (H, 40), "distance")
        moves = [m for m in exchanges(out) if "blk" in m]
        assert moves and all(re.fullmatch(r"hashpartitioning\(blk#\w+, \d+\)", m) for m in moves)
        got = predicted(spark, ten_isolated, readings, MODELS[name], "distance")
        assert np.allclose(got, dense_out(name, readings, "distance"), atol=1e-9)
    finally:
        spark.conf.unset("spark.flowgraph.broadcastRows")


def test_short_blocks_are_spread_over_more_tasks(spark):
    """Blocks that are cut shorter because the nodes are many do not gather in the tasks again."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = spark.range(12 * parts * 6).select(F.col("id").alias("t"), F.lit(1).alias("node_id"), F.lit(0.5).alias("flow"))
    rows = P.with_halo(steps, H, "step", 6).withColumn("task", F.spark_partition_id())
    in_task = [r["n"] for r in rows.groupBy("task").agg(F.countDistinct("blk").alias("n")).collect()]
    assert sum(in_task) == 12 * parts + 1 and max(in_task) < 12


def test_training_reads_packed_history(spark, readings):
    """Every step of training starts from arrays, whose windows are those of the sorted rows."""
    rows = P.with_halo(frame(spark, readings).withColumnRenamed("flow", "y"), H, "step", 12)
    sorted_rows = P.windows(rows, H, 12, lags={"y": "x"})
    packed = P.packed_windows(P.packed_series(rows, ["y"]), H, 12, ["y"], {"y": "x"})
    assert "Window" not in packed._jdf.queryExecution().optimizedPlan().toString()
    order = ["blk", "t", "node_id", "y", *P.lag_names(H, "x")]
    assert sorted(map(tuple, packed.select(*order).collect())) == sorted(map(tuple, sorted_rows.select(*order).collect()))


def test_attention_spreads_few_rows_at_once():
    """A batch of any size is handled in pieces, so the memory of a Python worker does not grow with it."""
    batch = pa.RecordBatch.from_pydict({"x": list(range(2 * L.PIECE_ROWS + 5))})
    assert [b.num_rows for b in L.pieces([batch])] == [L.PIECE_ROWS, L.PIECE_ROWS, 5]
    assert [x for b in L.pieces([batch]) for x in b.column("x").to_pylist()] == batch.column("x").to_pylist()


def test_large_scores_are_shifted(spark, ten_isolated, readings):
    """Scores far beyond the range of exp()."""
    big = readings * 40
    assert np.allclose(predicted(spark, ten_isolated, big, MODELS["gat"]), dense_out("gat", big), atol=1e-8)


def test_layers_on_windows_equal_filtered_series(spark, ten_isolated, readings):
    from flowgraph.operators.panel import lag_names, samples

    rows = samples(frame(spark, readings), H, (H, 40), layout="step")
    op = FC.operator_for(MODELS["gcn"], ten_isolated)
    for r in L.gcn_forward(rows, op, MODELS["gcn"], lag_names(H)).collect():
        assert r.prediction == pytest.approx(dense_out("gcn", readings)[r.t - H, r.node_id])


def test_attention_golden_row(spark, ten):
    """One feature per node, v / 10 + 1, no bias."""
    x = np.array([[v / 10 + 1.0] for v in range(10)])
    heads = L.Heads([[[1.0]]], 0, 24)
    blocks = L.packed(frame(spark, x).select(F.lit(0).cast("bigint").alias("blk"), "t", "node_id", F.col("flow").alias("y")), "y")
    done = L.unpacked(L.attend(blocks, G.adjacency(ten).anchor(ten), heads, [[0.0]]), {"series_1": "g"})
    out = {r.node_id: r.g for r in done.collect()}
    assert out[0] == pytest.approx(1.578646, abs=1e-6) and sum(out.values()) == pytest.approx(15.011486, abs=1e-6)


def test_parameter_tables(spark):
    for name, model in MODELS.items():
        again = L.params_from_table(L.parameter_table(spark, model), name)
        assert again == model
    assert sum(1 for _ in L.parameter_table(spark, L.init_gcn(6, 6, 1)).collect()) == 49
    assert L.parameter_table(spark, L.init_cheb(6, 6, 1, 2)).count() == 133
    assert L.parameter_table(spark, L.init_gat(6, 6, 1, 2)).count() == 97


def test_missing_bias_counts_as_zero(spark, ten_isolated, readings):
    bare = L.ChebParams(MODELS["cheb"].weight, [None, None])
    zero = L.ChebParams(MODELS["cheb"].weight, [[0.0] * 4, [0.0]])
    assert np.array_equal(predicted(spark, ten_isolated, readings, bare), predicted(spark, ten_isolated, readings, zero))


def loss(x, matrix, params, span):
    forward = dense_gcn if isinstance(params, L.GcnParams) else dense_cheb
    out = forward(x, matrix, params)[span[0] - H : span[1] - H]
    return ((out - x[:, span[0] : span[1]].T) ** 2).mean()


@pytest.mark.parametrize("name", ["gcn", "cheb"])
def test_gradient_against_finite_differences(spark, ten, name):
    x = np.random.default_rng(9).uniform(0, 1, (10, 16))
    span = (5, 15)
    params = MODELS[name]
    # Positive last bias, so that the output layer is alive.
    params = TR.with_values(params, {**TR.flat_params(params), "b2": np.array([0.4])})
    op = FC.operator_for(params, ten).settled()
    rows = TR.training_rows(frame(spark, x), ten, op, params, H, span)
    value, cells, gradient = TR.gradient_of(TR.filter_gradient(rows, op, params, H), params, H)
    matrix = dense(op, 10)
    assert cells == 100 and value == pytest.approx(loss(x, matrix, params, span))
    flat = TR.flat_params(params)
    for key, g in gradient.items():
        for at in np.ndindex(g.shape):
            moved = []
            for step in (1e-6, -1e-6):
                other = {k: v.copy() for k, v in flat.items()}
                other[key][at] += step
                moved.append(loss(x, matrix, TR.with_values(params, other), span))
            assert g[at] == pytest.approx((moved[0] - moved[1]) / 2e-6, abs=1e-6)


def test_training_lowers_the_loss(spark, ten):
    t = np.arange(60)
    x = 0.5 + 0.3 * np.sin(t / 5 + np.arange(10)[:, None])
    start = TR.with_values(MODELS["gcn"], {**TR.flat_params(MODELS["gcn"]), "b2": np.array([0.3])})
    done = TR.train(frame(spark, x), ten, start, H, (H, 50), epochs=3, batch_steps=24, rate=0.02)
    assert done.losses[-1] < done.losses[0] and len(done.losses) == 3


def test_linear_fit_matches_least_squares(spark, ten):
    x = np.random.default_rng(6).uniform(0, 1, (10, 30))
    params = MODELS["gcn"]
    op = FC.operator_for(params, ten)
    rows = TR.training_rows(frame(spark, x), ten, op, params, H, (H, 30))
    coefficients, intercept = TR.linear_fit(rows, TR.input_names(params, H))
    px = dense(op, 10) @ x
    a = np.array([[*px[v, t - H : t], 1.0] for v in range(10) for t in range(H, 30)])
    b = np.array([x[v, t] for v in range(10) for t in range(H, 30)])
    want = np.linalg.lstsq(a, b, rcond=None)[0]
    assert np.allclose([*coefficients, intercept], want, atol=1e-8)
    sums = {r.row: r for r in TR.gram(rows, TR.input_names(params, H)).collect()}
    assert sums[0].c_y == pytest.approx(a[:, 0] @ b) and sums[H].c_3 == len(b)


def test_dependent_inputs_get_no_coefficient(spark):
    x = np.random.default_rng(9).uniform(0, 1, (40, 2))
    rows = spark.createDataFrame([(float(a), 2 * float(a), float(b), 3 * float(a) - float(b) + 0.5) for a, b in x], "a double, twice double, b double, y double")
    coefficients, intercept = TR.linear_fit(rows, ["a", "twice", "b"])
    assert np.allclose([*coefficients, intercept], [3, 0, -1, 0.5], atol=1e-9)
    with pytest.raises(ValueError):
        TR.linear_fit(rows.where("a > 5"), ["a", "b"])


def test_neighbour_forecast_falls_back_to_mean(spark):
    from conftest import graph_of

    graph = graph_of(spark, [(0, 1, 1.0)], [0, 1, 2])
    x = np.array([[2.0, 4.0, 6.0, 8.0], [1.0, 1.0, 1.0, 1.0], [3.0, 3.0, 6.0, 9.0]])
    out = {(r.node_id, r.t): r for r in FC.neighbour_forecast(frame(spark, x), graph, 2, (2, 4)).collect()}
    assert out[0, 2].prediction == 3.0 and out[2, 3].prediction == 4.5 and out[1, 3].prediction == 5.0
    assert out[2, 3].target == 9.0


def test_softmax_states_merge_in_any_order(spark):
    """One pass over neighbours dealt anyhow agrees with a softmax of all of them, also for scores exp cannot take."""
    rng = np.random.default_rng(11)
    heads = L.Heads([[[1.0]], [[0.5]]], 0, 24)
    top, z, sums = [], [], []
    scores, values = rng.normal(0, 900, (300, 4, 2)), rng.normal(0, 1, (300, 4, 2))
    scores[5] = -np.inf
    starts = np.array([0])
    parts = np.array_split(rng.permutation(300), 17)
    for part in parts:
        live = np.isfinite(scores[part])
        a, b, c = L._merged(scores[part], live.astype(float), np.where(live, values[part], 0.0), starts, [1, 1])
        top.append(a), z.append(b), sums.append(c)
    best, total, weighted = L._merged(np.concatenate(top), np.concatenate(z), np.concatenate(sums), starts, [1, 1])
    e = np.exp(scores - scores.max(0))
    assert np.allclose(weighted[0] / total[0], (e * np.where(np.isfinite(scores), values, 0)).sum(0) / e.sum(0)) and (best[0] == scores.max(0)).all()
    none = L._merged(np.full((2, 1, 1), -np.inf), np.zeros((2, 1, 1)), np.zeros((2, 1, 1)), starts, [1])
    assert none[1].item() == 0 and none[2].item() == 0


@pytest.mark.parametrize("layout", ["step", "node"])
def test_attention_layouts_agree(spark, ten_isolated, readings, layout):
    x = frame(spark, readings)
    op = FC.operator_for(MODELS["gat"], ten_isolated).settled()
    from flowgraph.operators.panel import with_halo
    rows = with_halo(x.select("t", "node_id", F.col("flow").alias("y")), H, layout, 24)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r.node_id, r.t): r.prediction for r in L.gat_forward(rows, op, MODELS["gat"], H, 24, "y", layout=layout).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = dense_out("gat", readings)
    assert len(got) == 11 * (readings.shape[1] - H)
    for (node, t), value in got.items():
        assert value == pytest.approx(want[t - H, node])


def _first_attention(spark, graph, x, nodes=None):
    """Packed blocks of the readings `x`, the operator fitted to them, and the heads of the first layer; `nodes` more rows."""
    model = MODELS["gat"]
    panel = frame(spark, x) if nodes is None else frame(spark, x).unionByName(nodes)
    rows, block = FC.model_rows(panel, graph, model, H, (H, x.shape[1]))
    op = FC.fitted(FC.operator_for(model, graph, "distance").settled(), rows, FC.layout_for(graph), block)
    return L.packed(rows, "y"), op, L.Heads(model.heads, H, block)


def _attended(spark, graph, x, nodes=None):
    blocks, op, heads = _first_attention(spark, graph, x, nodes)
    assert op.dealt is None or "FlatMapCoGroupsInArrow" in L.attend(blocks, op, heads, MODELS["gat"].head_bias)._jdf.queryExecution().toString()
    done = L.attend(blocks, op, heads, MODELS["gat"].head_bias, layout=FC.layout_for(graph))
    names = [f"series_{c}" for c in range(1, len(heads.flat) + 1)]
    rows = L.unpacked(done, {"kept": "kept", **{n: n for n in names}}).collect()
    assert len({(r.node_id, r.t) for r in rows}) == len(rows)
    return {(r.node_id, r.t): [r.kept, *[r[n] for n in names]] for r in rows}


@pytest.mark.parametrize("entries", [4_000_000, 20])
def test_dealt_attention_meets_a_block_as_one_group(spark, ten_isolated, readings, monkeypatch, entries):
    """No row travels along an entry, in one slice or in several; a node without an id counts in the mean only, an unknown series in nothing."""
    x = np.array(readings, float)
    x[3] = np.nan
    lost = spark.range(x.shape[1]).select(F.lit(None).cast("bigint").alias("node_id"), F.col("id").alias("t"), F.lit(5.0).alias("flow"))
    want = _attended(spark, ten_isolated, x, lost)
    monkeypatch.setattr(L, "GROUP_ENTRIES", entries)
    monkeypatch.setattr(L, "CHUNK_CELLS", 64)
    spark.conf.set("spark.flowgraph.broadcastRows", "12")
    try:
        got = _attended(spark, ten_isolated, x, lost)
    finally:
        spark.conf.unset("spark.flowgraph.broadcastRows")
    assert got.keys() == want.keys() and len(got) == 11 * (x.shape[1] - H)
    assert np.allclose(np.array([got[k] for k in got], float), np.array([want[k] for k in got], float), equal_nan=True)


@pytest.mark.parametrize("cells", [16_000_000, 400])
def test_attention_weights_stay_packed(spark, ten_isolated, readings, monkeypatch, cells):
    """A row per receiver and block from the scores to the totals, not a row per pair and step; weights sum up to one."""
    monkeypatch.setattr(L, "GROUP_SCORES", cells)

    def totals():
        blocks, op, heads = _first_attention(spark, ten_isolated, readings)
        shares = L.attention_weights(L.attention_pairs(blocks, op, heads), heads)
        full = blocks.where(F.exists("steps", lambda t: (t >= F.col("blk") * heads.block) & (t >= H)))
        assert shares.count() == full.count()
        return {(r.i, r.j): r for r in L.pair_totals(shares, ["alpha_1", "alpha_2"]).collect()}

    want = totals()
    spark.conf.set("spark.flowgraph.broadcastRows", "12")
    try:
        got = totals()
    finally:
        spark.conf.unset("spark.flowgraph.broadcastRows")
    assert got.keys() == want.keys()
    for pair, r in got.items():
        assert r.live_alpha_1 == want[pair].live_alpha_1
        assert [r.alpha_1, r.alpha_2] == [v if v is None else pytest.approx(v) for v in (want[pair].alpha_1, want[pair].alpha_2)]
    live = [r for (i, _), r in got.items() if i == 0 and r.alpha_1 is not None]
    assert sum(r.alpha_1 for r in live) == pytest.approx(readings.shape[1] - H)
