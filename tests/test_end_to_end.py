"""From files to a saved forecast, the way the README shows it."""

import numpy as np
import pytest
from conftest import ROADS

from flowgraph.operators import layers, metrics
from flowgraph.plans import forecast
from flowgraph.schemas import Graph
from flowgraph.sources import edges, forecasts, panels


@pytest.mark.parametrize("variant", ["days", "clamped"])
def test_files_to_forecast(spark, tmp_path, variant):
    rng = np.random.default_rng(11)
    (tmp_path / "roads.csv").write_text("from,to,cost\n" + "\n".join(f"{a},{b},{w}" for a, b, w in ROADS))
    days = rng.uniform(10, 100, (3, 24, 10, 3))
    for n, day in enumerate(days):
        np.savez(tmp_path / f"day{n}.npz", data=day)
    graph = Graph.of_edges(edges.read_edges(spark, str(tmp_path / "roads.csv")))
    assert graph.counts().first() == (10, 14)
    panel = panels.read_cube(spark, str(tmp_path / "day*.npz"), steps_per_file=24)
    config = forecast.RunConfig(60, 6, (2, 1), variant=variant, n_steps=72)
    result = forecast.run(panel, graph, config)
    first, end = config.span("test")
    x = days[..., 0].reshape(72, 10).T
    low, high = x.min(1, keepdims=True), x.max(1, keepdims=True)
    scaled = (x - low) / (high - low)
    degree = np.zeros(10)
    for a, b, _ in ROADS:
        degree[a] += 1
        degree[b] += 1
    weight = np.zeros((10, 10))
    for a, b, _ in ROADS:
        weight[b, a] = (degree[a] * degree[b]) ** -0.5
    rows = result.collect()
    assert len(rows) == 10 * (end - first)
    for r in rows:
        mean = scaled[:, r.t - 6 : r.t].mean(1)
        value = (weight @ mean)[r.node_id] if weight[r.node_id].any() else mean[r.node_id]
        span = high[r.node_id, 0] - low[r.node_id, 0]
        assert r.prediction == pytest.approx(value * span + low[r.node_id, 0])
        assert r.target == pytest.approx(x[r.node_id, r.t])
    forecasts.write_forecast(result, str(tmp_path / "out"))
    again = metrics.metrics(forecasts.read_forecast(spark, str(tmp_path / "out"), "test")).first()
    assert again.n == len(rows) and again.rmse > 0


def test_models_run_by_parameters(spark, tmp_path):
    x = np.random.default_rng(12).uniform(10, 100, (30, 10, 3))
    np.savez(tmp_path / "all.npz", data=x)
    (tmp_path / "roads.csv").write_text("from,to,cost\n" + "\n".join(f"{a},{b},{w}" for a, b, w in ROADS))
    graph = Graph.of_edges(edges.read_edges(spark, str(tmp_path / "roads.csv")))
    panel = panels.read_cube(spark, str(tmp_path / "all.npz"))
    config = forecast.RunConfig(240, 6, (3, 2), fit_on="train", constant="zero")
    for model in (layers.init_gcn(6, 6, 1), layers.init_cheb(6, 6, 1, 2), layers.init_gat(6, 6, 1, 2)):
        result = forecast.run(panel, graph, config, model)
        assert result.count() == 120 and result.where("prediction is null").isEmpty()
    with pytest.raises(ValueError):
        forecast.run(panel, graph, config, "gcn")
