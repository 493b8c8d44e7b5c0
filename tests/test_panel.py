import numpy as np
import pytest
from pyspark.sql import functions as F

from flowgraph.functions import scalars as S
from flowgraph.operators import metrics as M
from flowgraph.operators import panel as P
from flowgraph.operators.ordered import running_sum, with_previous


def frame(spark, x):
    rows = [(v, t, float(x[v, t])) for v in range(x.shape[0]) for t in range(x.shape[1])]
    return spark.createDataFrame(rows, "node_id bigint, t bigint, flow double")


@pytest.mark.parametrize("layout,block", [("node", None), ("node", 7), ("step", 5), ("step", 3)])
def test_history_matches_slices(spark, layout, block):
    x = np.random.default_rng(1).normal(size=(3, 40))
    h = 4
    out = P.history(frame(spark, x), h, mean=True, layout=layout, block=block).collect()
    assert len(out) == 3 * 36
    for r in out:
        past = x[r.node_id, r.t - h : r.t]
        assert np.allclose([r[f"x_{k}"] for k in range(1, h + 1)], past)
        assert r.hist_mean == pytest.approx(past.mean()) and r.y == pytest.approx(x[r.node_id, r.t])


def test_history_with_gaps(spark):
    rows = [(0, t, float(t)) for t in (0, 1, 3, 4, 5, 9)]
    panel = spark.createDataFrame(rows, "node_id bigint, t bigint, flow double")
    out = {r.t: r for r in P.history(panel, 2, mean=True, dense=False, complete_only=False, block=4).collect()}
    assert (out[3].x_1, out[3].x_2, out[3].hist_mean) == (1.0, None, 1.0)
    assert (out[5].x_1, out[5].x_2, out[5].complete) == (3.0, 4.0, True)
    assert out[9].hist_mean is None and not out[9].complete


def test_splits():
    assert P.split_span("train", [45, 14], 5, 6) == (6, 45 * 288)
    first, end = P.split_span("test", [45, 14], 5, 6)
    assert end - first == 4032
    first, end = P.split_span("test", [45, 15], 5, 12, variant="clamped", n_steps=16992)
    assert (first, end) == (12972, 12972 + 4019)
    assert P.split_span("test", [1, 1], 360, 2, variant="clamped", n_steps=10) == (6, 9)
    assert P.split_span("train", [1, 1], 360, 2) == (2, 4) and P.split_span("test", [1, 1], 360, 2) == (4, 8)
    for bad in ({"mode": "valid"}, {"mode": "test", "variant": "other"}, {"mode": "test", "variant": "clamped"}):
        with pytest.raises(ValueError):
            P.split_span(bad.pop("mode"), [1, 1], 5, 6, **bad)


def test_scaling(spark):
    x = np.array([[1.0, 3.0, 5.0], [4.0, 4.0, 4.0]])
    panel = frame(spark, x)
    base = P.fit_base(panel)
    scaled = {(r.node_id, r.t): r.flow for r in P.scale(panel, base).collect()}
    assert [scaled[0, t] for t in range(3)] == [0.0, 0.5, 1.0] and scaled[1, 0] is None
    zero = {(r.node_id, r.t): r.flow for r in P.scale(panel, base, constant="zero").collect()}
    assert zero[1, 2] == 0.0
    back = {(r.node_id, r.t): r.flow for r in P.unscale(P.scale(panel, base, constant="zero"), base, ["flow"]).collect()}
    assert back == {(v, t): x[v, t] for v in range(2) for t in range(3)}
    train = {r.node_id: r.max_flow for r in P.base_table(panel, span=(0, 2)).collect()}
    assert train[0] == 3.0


def test_densify_sums_and_fills(spark):
    readings = spark.createDataFrame([(1, 0, 2.0), (1, 0, 3.0), (1, 30, 1.0), (2, 99, 9.0)], "node_id bigint, t bigint, flow double")
    nodes = spark.createDataFrame([(1,), (2,)], "node_id bigint")
    dense = {(r.node_id, r.t): r.flow for r in P.densify(readings, nodes, 31).collect()}
    assert len(dense) == 62 and dense[1, 0] == 5.0 and dense[1, 30] == 1.0 and sum(dense.values()) == 6.0
    assert P.densify(readings, nodes, 31, fill=None).where("flow is null").count() == 60


def test_batches(spark):
    span = (6, 480)
    steps = spark.range(*span).select(F.col("id").alias("t"))
    seen = {}
    for epoch in (0, 1):
        numbered = steps.select("t", P.batch_shuffled(F.col("t"), span, 3, epoch).alias("b")).collect()
        sizes = np.bincount([r.b for r in numbered])
        assert sizes.tolist() == [64] * 7 + [26]
        seen[epoch] = [r.b for r in numbered]
    assert seen[0] != seen[1] and sorted(seen[0]) != seen[0]
    ordered = steps.select(P.batch_in_order(F.col("t"), 6).alias("b")).distinct().count()
    assert ordered == 8


def test_arrays_slices_first(spark):
    x = np.arange(60.0).reshape(2, 30)
    panel = frame(spark, x)
    arrays = P.to_series_arrays(panel, ["flow"], 12)
    assert {(r.node_id, r.block): len(r.flow) for r in arrays.collect()} == {(v, b): 12 if b < 2 else 6 for v in (0, 1) for b in range(3)}
    assert sorted(P.from_series_arrays(arrays, ["flow"]).collect()) == sorted(panel.collect())
    part = P.slice_node(panel, 1, (5, 8), ["flow"]).orderBy("step").collect()
    assert [(r.step, r.flow) for r in part] == [(0, 35.0), (1, 36.0), (2, 37.0)]
    assert P.first_samples(panel, 3).count() == 6


def test_previous_and_running_sum(spark):
    rng = np.random.default_rng(2)
    rows = [(int(a), n, int(rng.integers(0, 9))) for n, a in enumerate(rng.integers(0, 4, 500))]
    df = spark.createDataFrame(rows, "a int, n int, v int").repartition(4)
    ordered = sorted(rows)
    before = {r[:2]: (ordered[k - 1][2] if k else None) for k, r in enumerate(ordered)}
    assert {(r.a, r.n): r.prev_v for r in with_previous(df, ["a", "n"], ["v"]).collect()} == before
    numbers = spark.range(100).select("id", (F.col("id") * 1.0).alias("x"))
    sums = {r.id: r.s for r in running_sum(numbers, "id", "x", "s", chunk=7).collect()}
    assert sums == {k: k * (k + 1) / 2 for k in range(100)}


def test_metrics_match_formulas(spark):
    rng = np.random.default_rng(4)
    y, p = rng.uniform(0, 9, 130), rng.uniform(0, 9, 130)
    rows = [(0, t, float(p[t]), float(y[t])) for t in range(130)]
    forecast = spark.createDataFrame(rows, "node_id bigint, t bigint, prediction double, target double")
    got = M.metrics(forecast).first()
    assert got.mae == pytest.approx(np.abs(y - p).mean()) and got.mape == pytest.approx((np.abs(y - p) / (y + 5)).mean())
    assert got.rmse == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    cuts = [slice(0, 64), slice(64, 128), slice(128, 130)]
    per_batch = [np.sqrt(((y[c] - p[c]) ** 2).mean()) for c in cuts]
    assert M.mean_batch_metrics(forecast, 0).first().rmse == pytest.approx(np.mean(per_batch))
    losses = M.batch_loss(forecast, P.batch_in_order(F.col("t"), 0))
    running = [r.loss for r in M.running_loss(losses, 130).orderBy("batch_id").collect()]
    assert running == pytest.approx(list(np.cumsum([b**2 for b in per_batch]) * 1000 / 130))
    assert M.epoch_loss(losses, 130).first().loss == pytest.approx(running[-1])
    bounds = M.value_bounds(forecast).first()
    assert (bounds.low, bounds.high) == (min(y.min(), p.min()), max(y.max(), p.max()))


def test_profile_percentiles(spark):
    panel = spark.range(1000).select(F.col("id").alias("node_id"), F.col("id").alias("t"), F.col("id").cast("double").alias("flow"), F.lit(2.0).alias("occupy"))
    out = {r.feature: r for r in P.feature_profile(panel, ["flow", "occupy"], percentiles=[0.5]).collect()}
    assert abs(out["flow"].percentiles[0] - 500) < 5 and out["flow"].bin_0 == 100 and out["occupy"].bin_0 == 1000
    assert out["occupy"].variation == 0.0


def test_time_functions(spark):
    df = spark.sql("select timestamp '2023-01-01 00:00:00' + make_interval(0,0,0,0,cast(id as int),0,0) as ts, id as t from range(48)")
    out = df.select("t", S.step_of(F.col("ts"), "2023-01-01 00:00:00", 60).alias("s"), S.formatted_time(F.col("ts")).alias("text"),
                    S.day_band(F.hour("ts")).alias("band"), S.band_factor(F.hour("ts")).alias("f")).orderBy("t").collect()
    assert all(r.t == r.s for r in out) and out[25].text == "2023-01-02 01:00:00"
    assert [r.band for r in out[:24]].count("peak") == 6 and [r.f for r in out[:24]].count(0.5) == 8
    assert out[6].band == "normal" and out[22].band == "night"


def test_nulls_stay_null_and_are_counted(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (2.0,)], "x double")
    assert [r.y for r in df.select(S.relu(F.col("x")).alias("y")).collect()] == [None, 0.0, 2.0]
    rows = [(0, 0, 1.0, 2.0), (0, 1, None, 2.0), (0, 2, 3.0, None)]
    got = M.metrics(spark.createDataFrame(rows, "node_id bigint, t bigint, prediction double, target double")).first()
    assert (got.n, got.skipped, got.mae) == (1, 2, 1.0)
