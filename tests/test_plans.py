"""The physical plans: where rows move, and where they do not."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_panel import frame

from flowgraph.operators import layers as L
from flowgraph.plans import forecast as FC
from flowgraph.plans.sizing import checkpoint_folder, shared_path, sized_join


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return [e for e in re.findall(r"Exchange (\w+\([^)]*\)|\w+)", plan(df)) if e.startswith(("hash", "range", "Single"))]


@pytest.fixture(scope="module")
def readings(spark, tmp_path_factory):
    """A panel read from a file, so that the plan starts with a scan."""
    path = str(tmp_path_factory.mktemp("panel") / "p")
    frame(spark, np.random.default_rng(1).uniform(size=(10, 60))).write.parquet(path)
    return spark.read.parquet(path)


def by_block(df):
    return [e for e in exchanges(df) if "blk" in e]


def test_neighbour_forecast_moves_rows_once(spark, ten, readings):
    moves = by_block(FC.neighbour_forecast(readings, ten, 6, (6, 60)))
    assert len(moves) == 1 and re.fullmatch(r"hashpartitioning\(blk#\w+, \d+\)", moves[0])


@pytest.mark.parametrize("model", [L.init_gcn(6, 6, 1), L.init_cheb(6, 6, 1, 2)])
def test_networks_move_rows_once(spark, ten, readings, model):
    assert len(by_block(FC.model_forecast(readings, ten, model, 6, (6, 60)))) == 1


def test_attention_moves_readings_only(spark, ten, readings):
    moves = by_block(FC.model_forecast(readings, ten, L.init_gat(6, 6, 1, 2), 6, (6, 60)))
    assert moves and all(re.fullmatch(r"hashpartitioning\(blk#\w+, \d+\)", m) for m in moves)


def test_step_filter_reaches_the_scan(spark, ten, readings):
    text = plan(FC.neighbour_forecast(readings, ten, 6, (30, 60)))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(t,24\)[^\]]*LessThan\(t,60\)", text)


def test_join_beyond_the_bound_is_salted(spark):
    many = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    few = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, name string")
    small = sized_join(many, few, "k", 2, spread="v")
    large = sized_join(many, few, "k", 10**9, spread="v")
    assert "_salt" not in plan(small) and "_salt" in plan(large)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_checkpoints_go_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    assert named and named in checkpoint_folder(spark)
    assert shared_path(spark, "x").startswith(checkpoint_folder(spark) + "/x-")
