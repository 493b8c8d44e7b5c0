"""Networks inside a block of steps, beyond the broadcast bound, against the plans below it."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_models import H, MODELS
from test_panel import frame
from test_plans import plan

from flowgraph.operators import graph as G
from flowgraph.operators import inblock as I
from flowgraph.operators import layers as L
from flowgraph.operators import panel as P
from flowgraph.operators import propagate as R
from flowgraph.plans import forecast as FC
from flowgraph.plans import train as TR

STEPS = 40


@pytest.fixture(scope="module", params=["whole", "unknown"])
def readings(request):
    """With "unknown", the series of a node and some readings of others are null."""
    x = np.random.default_rng(8).uniform(0, 1, (11, STEPS))
    if request.param == "unknown":
        x[3] = np.nan
        x[5, 20:23] = np.nan
    return x


def panel(spark, x):
    return frame(spark, x).withColumn("flow", F.nanvl("flow", F.lit(None).cast("double")))


def both(spark, make, where=None):
    """What `make` gives below and beyond the broadcast bound; beyond, no row is hashed for a join within a block."""
    want = sorted(map(tuple, make().collect()), key=repr)
    spark.conf.set("spark.flowgraph.broadcastRows", "12")
    try:
        df = make()
        text = plan(df)
        assert "FlatMapGroupsInArrow" in text and "ShuffledHashJoin" not in text and (where is None or where in text)
        got = sorted(map(tuple, df.collect()), key=repr)
    finally:
        spark.conf.unset("spark.flowgraph.broadcastRows")
    return want, got


def alike(want, got):
    assert len(want) == len(got) > 0
    assert [[v is None for v in r] for r in want] == [[v is None for v in r] for r in got]
    assert np.allclose([[0.0 if v is None else v for v in r] for r in want], [[0.0 if v is None else v for v in r] for r in got], atol=1e-9)


def keyed(df):
    return df.select("node_id", "t", *[c for c in df.columns if c not in ("blk", "node_id", "t")])


@pytest.mark.parametrize("name", ["gcn", "cheb"])
def test_layers_run_in_the_block(spark, ten_isolated, readings, name):
    forward = L.gcn_forward if name == "gcn" else L.cheb_forward

    def make():
        rows = P.samples(panel(spark, readings), H, (H, STEPS), layout="step", block=FC.network_block(ten_isolated, H))
        op = FC.fitted(FC.operator_for(MODELS[name], ten_isolated), rows, "step", FC.network_block(ten_isolated, H))
        return keyed(forward(rows, op, MODELS[name], P.lag_names(H), carry=["y"]))

    alike(*both(spark, make))


@pytest.mark.parametrize("name", ["gcn", "cheb", "gat"])
def test_scores_run_in_the_block(spark, ten_isolated, readings, name):
    def make():
        return keyed(FC.model_forecast(panel(spark, readings), ten_isolated, MODELS[name], H, (H, STEPS), "distance"))

    if name != "gat":
        alike(*both(spark, make))
        return
    # attention is dealt at any size; the other way is that of the node layout
    want = sorted(map(tuple, make().collect()), key=repr)
    assert "FlatMapCoGroupsInArrow" not in plan(make()) and "FlatMapGroupsInArrow" in plan(make())
    spark.conf.set("spark.flowgraph.broadcastRows", "0")
    try:
        alike(want, sorted(map(tuple, make().collect()), key=repr))
    finally:
        spark.conf.unset("spark.flowgraph.broadcastRows")


@pytest.mark.parametrize("carry", [[], ["y"]])
def test_basis_runs_in_the_block(spark, ten_isolated, readings, carry):
    def make():
        rows = P.with_halo(panel(spark, readings), 0, "step", 24).withColumn("y", F.col("flow") * 2)
        op = FC.fitted(G.laplacian(G.adjacency(ten_isolated), ten_isolated), rows, "step", 24)
        return keyed(R.chebyshev_basis(rows, op, ["flow"], 3, carry))

    alike(*both(spark, make))


@pytest.mark.parametrize("name", ["gcn", "cheb"])
def test_gradient_runs_in_the_block(spark, ten_isolated, readings, name):
    def make():
        op = FC.operator_for(MODELS[name], ten_isolated).settled()
        rows, op = TR.settled_rows(panel(spark, readings), ten_isolated, op, MODELS[name], H, (H, 30))
        return TR.filter_gradient(rows, op, MODELS[name], H)

    alike(*both(spark, make))


@pytest.mark.parametrize("name", ["gcn", "cheb"])
def test_training_runs_in_the_block(spark, ten, name):
    x = panel(spark, np.random.default_rng(2).uniform(0, 1, (10, 30)))
    train = lambda: TR.train(x, ten, MODELS[name], H, (H, 30), epochs=2, batch_steps=None, rate=0.01)
    want = train()
    spark.conf.set("spark.flowgraph.broadcastRows", "12")
    try:
        got = train()
    finally:
        spark.conf.unset("spark.flowgraph.broadcastRows")
    assert np.allclose(want.losses, got.losses)
    assert all(np.allclose(a, b) for a, b in zip(L._tensors(want.params).values(), L._tensors(got.params).values()))


def test_network_blocks_stay_long(spark, ten):
    """Entries move once per block, so blocks do not shrink as fast as those of plans that hold a block in memory."""
    graph = G.replace(ten, n_vertices=540_000, n_edges=7_200_000)
    assert FC.block_for(graph, 6) == 6 and FC.network_block(graph, 6) == 24
    assert FC.network_block(graph, 6, entries=100) == 6


def test_pairs_leave_a_block_in_pieces(spark, ten_isolated, readings, monkeypatch):
    """Entries are handled as they come: rows of the same receiver stay whole, however few scores may leave at once."""
    monkeypatch.setattr(L, "GROUP_SCORES", 1)
    x = panel(spark, readings)
    rows, block = FC.model_rows(x, ten_isolated, MODELS["gat"], H, (H, STEPS))
    heads = L.Heads(MODELS["gat"].heads, H, block)
    op = FC.operator_for(MODELS["gat"], ten_isolated, "distance").settled()
    want = L.pair_totals(L.attention_pairs(L.packed(rows, "y"), op, heads), ["s_1", "s_2"])
    pairs = L.attention_pairs(L.packed(rows, "y"), FC.fitted(op, rows, "step", block, always=True), heads)
    assert "FlatMapGroupsInArrow" in plan(pairs) and "CoGroups" not in plan(pairs)
    alike(*[sorted(map(tuple, df.select("i", "j", "live_s_1", "s_1", "live_s_2", "s_2").collect()), key=repr) for df in (want, L.pair_totals(pairs, ["s_1", "s_2"]))])


def test_entries_are_read_in_pieces(tmp_path, monkeypatch):
    """A pass reads the entries from a file, PIECE_ENTRIES at once; sparse ids, unknown senders, null weights and a missing receiver."""
    rng = np.random.default_rng(4)
    ids = np.sort(rng.choice(10**15, 30, replace=False))
    dense = np.where(rng.random((30, 30)) < 0.3, rng.normal(size=(30, 30)), 0.0)
    np.fill_diagonal(dense, 1.0)
    monkeypatch.setattr(I, "PIECE_ENTRIES", 16)
    edges = I.Edges(str(tmp_path))
    js = [[*ids[np.flatnonzero(row)].tolist(), None] for row in dense]
    ws = [[*row[np.flatnonzero(row)].tolist(), 5.0] for row in dense]
    edges.add(pa.RecordBatch.from_arrays([pa.array(ids), pa.array(js, pa.list_(pa.int64())), pa.array(ws, pa.list_(pa.float64()))], ["node_id", "js", "ws"]))
    edges.settle()
    assert edges.count > 10 and (edges.ids == ids).all()
    x, rows = np.append(rng.normal(size=30), 0.0), np.append(np.ones(30, bool), False)
    ((y, known),), reached = edges.spread([(x, rows)], rows)
    assert np.allclose(y[:30], dense @ x[:30]) and (known == rows).all() and (reached == rows).all()
    ((y, known),), _ = edges.spread([(x, rows)], rows, 2.0, plus=[(x, rows)])
    assert np.allclose(y[:30], 2 * dense @ x[:30] + x[:30])
    ((y, known),), _ = edges.spread([(x, rows)], rows, flipped=True)
    assert np.allclose(y[:30], dense.T @ x[:30]) and (known == rows).all()
