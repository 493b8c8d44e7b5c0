import numpy as np
import pytest
from conftest import ROADS, graph_of
from pyspark.sql import functions as F

from flowgraph.operators import components as C
from flowgraph.operators import graph as G
from flowgraph.operators import propagate as R
from flowgraph.schemas import NAMED_EDGE_SCHEMA, NAMED_VERTEX_SCHEMA, Graph


def dense(op, n):
    a = np.zeros((n, n))
    for r in op.df.collect():
        if r.w is not None:
            a[r.i, r.j] += r.w
    return a


def dense_adjacency(n=10, distance=False):
    a = np.zeros((n, n))
    for s, d, w in ROADS:
        a[s, d] = a[d, s] = 1 / w if distance else 1
    return a


def test_adjacency_and_matrices_match_dense(ten):
    adj = G.adjacency(ten)
    a = dense_adjacency()
    assert np.array_equal(dense(adj, 10), a)
    assert adj.df.count() == 28
    distance = dense(G.adjacency(ten, "distance"), 10)
    assert np.allclose(distance, dense_adjacency(distance=True)) and distance.sum() == pytest.approx(8.360268, abs=1e-6)
    looped = a + np.eye(10)
    walk = dense(G.random_walk(adj, ten), 10)
    assert np.allclose(walk, looped / looped.sum(1, keepdims=True)) and np.allclose(walk.sum(1), 1)
    assert np.trace(walk) == pytest.approx(2.75, abs=1e-6)
    scale = a.sum(1) ** -0.5
    lap = dense(G.laplacian(adj, ten), 10)
    assert np.allclose(lap, np.eye(10) - scale[:, None] * a * scale)
    assert np.trace(lap @ lap) == pytest.approx(13.555556, abs=1e-6) and lap.sum() == pytest.approx(0.219372, abs=1e-6)
    assert np.allclose(dense(G.laplacian(adj, ten, normalize=False), 10), np.diag(a.sum(1)) - a)


def test_unknown_modes_raise(ten):
    with pytest.raises(ValueError):
        G.adjacency(ten, "other")
    with pytest.raises(ValueError):
        G.degrees(ten.edges, "other")


def test_isolated_vertex_has_identity_row(ten_isolated):
    lap = dense(G.laplacian(G.adjacency(ten_isolated), ten_isolated), 11)
    assert np.array_equal(lap[10], np.eye(11)[10]) and not np.isnan(lap).any()
    walk = dense(G.random_walk(G.adjacency(ten_isolated), ten_isolated), 11)
    assert np.array_equal(walk[10], np.eye(11)[10])


def test_conflicting_costs_take_the_smallest(spark):
    graph = graph_of(spark, [(0, 1, 4), (1, 0, 2), (0, 1, 8)], [0, 1])
    assert {r.w for r in G.adjacency(graph, "distance").df.collect()} == {0.5}
    assert {r.degree for r in G.degree_table(graph).collect()} == {3}


def test_directed_convolution(spark, ten):
    features = spark.createDataFrame([(v, v / 10) for v in range(10)], "node_id bigint, x double")
    out = R.directed_convolution(features, ten, ["x"]).collect()
    assert len(out) == 10 and sum(r.x for r in out) == pytest.approx(2.122408, abs=1e-6)


def test_chebyshev_recurrence_and_sum(spark, ten):
    op = G.laplacian(G.adjacency(ten), ten)
    lap = dense(op, 10)
    t2 = 2 * lap @ lap - np.eye(10)
    t3 = 2 * lap @ t2 - lap
    assert np.trace(t2) == pytest.approx(17.111111, abs=1e-6)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(10, 7))
    rows = [(v, t, float(x[v, t])) for v in range(10) for t in range(7)]
    frame = spark.createDataFrame(rows, "node_id bigint, t bigint, x double")
    basis = R.chebyshev_basis(frame, op, ["x"], 3)
    for r in basis.collect():
        expected = [x[r.node_id, r.t], (lap @ x)[r.node_id, r.t], (t2 @ x)[r.node_id, r.t], (t3 @ x)[r.node_id, r.t]]
        assert np.allclose([r.x_k0, r.x_k1, r.x_k2, r.x_k3], expected)
    taps = frame.select("node_id", "t", *[(F.col("x") * (k + 1)).alias(f"z{k}") for k in range(4)])
    for order, matrix in enumerate([np.eye(10), np.eye(10) + 2 * lap, np.eye(10) + 2 * lap + 3 * t2,
                                    np.eye(10) + 2 * lap + 3 * t2 + 4 * t3]):
        got = R.chebyshev_sum(taps, op, [[f"z{k}"] for k in range(order + 1)], ["y"]).collect()
        assert len(got) == 70
        assert np.allclose([r.y for r in got], [(matrix @ x)[r.node_id, r.t] for r in got])


@pytest.mark.parametrize("broadcast", ["1000000", "0"])
def test_propagate_keeps_steps_apart(spark, ten_isolated, broadcast):
    """Broadcast and salted joins give the same rows, with steps missing here and there."""
    spark.conf.set("spark.flowgraph.broadcastRows", broadcast)
    try:
        rows = [(v, t, float(v * 100 + t)) for v in range(11) for t in range(60) if (v * 7 + t) % 5]
        frame = spark.createDataFrame(rows, "node_id bigint, t bigint, x double")
        a = dense_adjacency(11)
        known = {(v, t): x for v, t, x in rows}
        op = G.adjacency(ten_isolated)
        got = {(r.node_id, r.t): r.x for r in R.propagate(frame, op, ["x"]).collect()}
        want = {}
        for (v, t), x in known.items():
            for i in range(11):
                if a[i, v]:
                    want[i, t] = want.get((i, t), 0.0) + x
        assert got == want
        kept = R.propagate(frame, op.anchor(ten_isolated), ["x"], carry=["x"], out=["y"]).collect()
        assert {(r.node_id, r.t): r.x for r in kept if r.x is not None} == known
        assert {(r.node_id, r.t): r.y for r in kept if r.y is not None} == want
    finally:
        spark.conf.unset("spark.flowgraph.broadcastRows")


def ring(spark, edges=(("A", "B"), ("B", "C"), ("C", "D"), ("D", "A")), nodes="ABCD"):
    vertices = spark.createDataFrame([(n, f"Place {n}") for n in nodes], NAMED_VERTEX_SCHEMA)
    roads = spark.createDataFrame([(a, b, f"Road {a}{b}") for a, b in edges], NAMED_EDGE_SCHEMA)
    return Graph.of(vertices, roads, check=True)


def test_additive_rounds_on_ring(spark):
    start = spark.createDataFrame([("A", 1.0, "a"), ("B", 2.0, "b"), ("C", 4.0, "c"), ("D", 8.0, "d")], "node_id string, x double, note string")
    done = {r.node_id: r for r in R.additive_rounds(ring(spark), start, "x").collect()}
    assert {k: r.x for k, r in done.items()} == {"A": 39.0, "B": 33.0, "C": 21.0, "D": 27.0}
    assert done["A"].note == "a"
    assert {r.node_id: r.x for r in R.additive_rounds(ring(spark), start, "x", rounds=5).collect()}["A"] == 39 + 27 + 27 + 21


def test_additive_rounds_null_modes(spark):
    path = ring(spark, (("A", "B"), ("B", "C")), "ABC")
    start = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 4.0)], "node_id string, x double")

    def after(rounds, mode):
        return {r.node_id: r.x for r in R.additive_rounds(path, start, "x", rounds, mode).collect()}

    assert after(1, "propagate") == {"A": None, "B": 3.0, "C": 6.0}
    assert after(2, "propagate") == {"A": None, "B": None, "C": 9.0}
    assert after(1, "zero") == {"A": 1.0, "B": 3.0, "C": 6.0}
    with pytest.raises(ValueError):
        after(1, "other")


def test_dangling_edge_raises(spark):
    with pytest.raises(ValueError):
        ring(spark, (("A", "Z"),), "AB")


@pytest.mark.parametrize("broadcast", ["1000000", "0"])
def test_components_against_union_find(spark, broadcast):
    rng = np.random.default_rng(5)
    n = 120
    edges = [(int(a), int(b), 1.0) for a, b in rng.integers(0, n, (70, 2))]
    edges += [(0, k, 1.0) for k in range(60, 80)] + [(k, k + 1, 1.0) for k in range(90, 110)]
    parent = list(range(n))

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b, _ in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    spark.conf.set("spark.flowgraph.broadcastRows", broadcast)
    try:
        found = C.connected_components(graph_of(spark, edges, range(n)))
        assert {r.node_id: r.component for r in found.collect()} == {v: find(v) for v in range(n)}
    finally:
        spark.conf.unset("spark.flowgraph.broadcastRows")


def test_remap_unknown_id(spark, ten):
    order = spark.createDataFrame([(v, 9 - v) for v in range(9)], "raw_id bigint, idx bigint")
    with pytest.raises(KeyError):
        G.to_dense_ids(ten.edges, order, 9)
    kept = G.to_dense_ids(ten.edges, order, 9, unknown="drop")
    assert kept.count() == 22
    assert [r.node_id for r in G.unknown_ids(ten.edges, order).collect()] == [9]


def _star(spark, leaves):
    """One hub that sends to every leaf, and a ring of leaves."""
    edges = [(0, n, 1.0) for n in range(1, leaves + 1)] + [(n, n % leaves + 1, 2.0) for n in range(1, leaves + 1)]
    return graph_of(spark, edges, range(leaves + 1))


@pytest.mark.parametrize("steps", [None, 24])
def test_heavy_sender_is_dealt_over_slices(spark, steps):
    graph = _star(spark, 500)
    op = R.plain_edges(graph)
    rows = [(n, float(n + 1)) for n in range(501)]
    if steps:
        rows = [(n, t, x + t) for n, x in rows for t in range(steps)]
        features = spark.createDataFrame(rows, "node_id long, t long, x double")
    else:
        features = spark.createDataFrame(rows, "node_id long, x double")
    want = R.propagate(features, op, ["x"], way="broadcast")
    got = R.propagate(features, op, ["x"], way="split", heavy=50)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() == 500 * (steps or 1)
    matrix = op.df.select("i", F.col("j").alias("node_id"), "w")
    heavy = R.heavy_senders(matrix, 50).collect()
    assert [(r.node_id, r._slices) for r in heavy] == [(0, 10)]
    packed = features.groupBy("node_id").agg(F.sum("x").alias("x"))
    # a slice of the hub holds a tenth of its entries, give or take; so does a task
    dealt = R.split_messages(packed, matrix, op.rows, 50).where("node_id = 0")
    slices = dealt.groupBy(F.pmod(F.xxhash64("i"), F.lit(10))).count().collect()
    assert dealt.count() == 500 and len(slices) == 10 and max(r["count"] for r in slices) < 100


def test_way_is_checked(spark, ten):
    with pytest.raises(ValueError):
        R.messages(spark.range(1).withColumnRenamed("id", "node_id"), R.plain_edges(ten), "other")
