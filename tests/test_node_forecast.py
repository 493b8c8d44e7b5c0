"""The forecast of some nodes from the readings of their neighbourhood, and ordered output."""

import os

import numpy as np
import pytest
from conftest import graph_of
from pyspark.sql import functions as F
from test_panel import frame

from flowgraph.operators import layers as L
from flowgraph.plans import driver_tables as D
from flowgraph.plans import forecast as FC
from flowgraph.plans.sizing import settle, shared_path
from flowgraph.sources import forecasts as SF

# One day of hours to train on and one to test on.
CONFIG = FC.RunConfig(60, 3, (1, 1))
MODELS = {"none": None, "gcn": L.init_gcn(3, 4, 1), "cheb": L.init_cheb(3, 4, 1, 2), "gat": L.init_gat(3, 4, 1, 2)}


@pytest.fixture(scope="module")
def chain(spark):
    """Twelve places in a row, and one apart."""
    return graph_of(spark, [(k, k + 1, 1.0 + k) for k in range(11)], range(13))


@pytest.mark.parametrize("name", MODELS)
def test_same_as_the_whole_forecast(spark, chain, name):
    panel = frame(spark, np.random.default_rng(5).uniform(size=(13, 48)))
    nodes = spark.createDataFrame([(6,), (7,), (12,)], "node_id bigint")
    asked = []

    def read(near, span):
        asked.append((sorted(r.node_id for r in near.df.collect()), span))
        part = panel.join(near.df, "node_id", "left_semi")
        return part if span is None else part.where((F.col("t") >= span[0]) & (F.col("t") < span[1]))

    got = {(r.node_id, r.t): r for r in FC.node_forecast(read, chain, CONFIG, nodes, (30, 40), MODELS[name]).collect()}
    whole = FC.run(panel, chain, CONFIG, MODELS[name]).where("node_id in (6, 7, 12) and t >= 30 and t < 40").collect()
    assert len(got) == len(whole) == 30
    for r in whole:
        assert got[r.node_id, r.t].prediction == pytest.approx(r.prediction, rel=1e-9)
        assert got[r.node_id, r.t].target == pytest.approx(r.target, rel=1e-9)
    # One entry of the directed operator, two of the symmetric one, or two times the order of the Chebyshev terms.
    # Attention may need the mean over all places.
    ends = {"none": (5, 7), "gcn": (4, 9), "cheb": (2, 11), "gat": (0, 11)}[name]
    assert asked == [([*range(ends[0], ends[1] + 1), 12], None), ([*range(ends[0], ends[1] + 1), 12], (27, 40))]


def test_filters_reach_the_scan(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    nodes = D.sensors(spark, folder).orderBy("node_id").limit(3)
    days = D.calendar(spark, folder)
    part = D.panel_part(spark, folder, settle(nodes), (100, 120), days)
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("DataFilters") :]
    assert "user_id" in filters and "ts#" in filters and "Filter" in plan
    whole = D.panel(spark, folder).where("t >= 100 and t < 120").join(nodes, "node_id", "left_semi")
    assert sorted(part.select("node_id", "t", "flow").collect()) == sorted(whole.select("node_id", "t", "flow").collect())


def test_a_long_list_of_nodes_is_joined(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    near = settle(D.sensors(spark, folder))
    listed = sorted(D.panel_part(spark, folder, near, (0, 30)).collect())
    monkeypatch.setattr(D, "LISTED_NODES", 1)
    assert sorted(D.panel_part(spark, folder, near, (0, 30)).collect()) == listed


def test_files_follow_each_other_in_order(spark):
    path = shared_path(spark, "test-ordered")
    rows = spark.range(5000).select(((F.col("id") * 7919) % 97).alias("node_id"), F.col("id").alias("t"), F.rand(1).alias("prediction"))
    SF.write_ordered(rows, path, files=5)
    got = SF.read_ordered(spark, path).collect()
    want = sorted((r.node_id, r.t, r.prediction) for r in rows.collect())
    assert sorted((r.position, r.node_id, r.t, r.prediction) for r in got) == [(n, *r) for n, r in enumerate(want)]
    names = {r[0] for r in spark.read.parquet(path).select(F.col("_metadata.file_name")).collect()}
    assert len(names) == 5


def test_ordered_empty_table(spark):
    path = shared_path(spark, "test-ordered-empty")
    SF.write_ordered(spark.createDataFrame([], "node_id bigint, t bigint, x double"), path)
    assert SF.read_ordered(spark, path).collect() == []
