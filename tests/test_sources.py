import numpy as np
import pytest

from flowgraph.operators.panel import Base
from flowgraph.schemas import TIMED_READING_SCHEMA
from flowgraph.sources import arrays as SA
from flowgraph.sources import edges as SE
from flowgraph.sources import forecasts as SF
from flowgraph.sources import panels as SP


def test_edge_file_with_bad_rows(spark, tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text("from,to,cost\n1,2,3.5\n4,5\n6,x,1.0\n7,8,9.0,10\n2,3,1\n")
    good = SE.read_edges(spark, str(path))
    assert sorted(map(tuple, good.collect())) == [(1, 2, 3.5), (2, 3, 1.0)] and good.select("src").count() == 2
    assert sorted(r.row for r in SE.rejected_edges(spark, str(path)).collect()) == ["4,5", "6,x,1.0", "7,8,9.0,10"]
    assert SE.rejected_edges(spark, str(path)).count() == 3


def test_node_order_keeps_line_order(spark, tmp_path):
    ids = np.random.default_rng(0).permutation(5000)
    path = tmp_path / "order.txt"
    path.write_text("\n".join(map(str, ids)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {r.idx: r.raw_id for r in SE.read_node_order(spark, str(path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [got[k] for k in range(5000)] == ids.tolist()


def test_cube_files(spark, tmp_path):
    cube = np.random.default_rng(1).uniform(size=(20, 4, 3))
    np.savez(tmp_path / "all.npz", data=cube)
    for day in (0, 1):
        np.save(tmp_path / f"day{day}.npy", cube[day * 10 : day * 10 + 10])
    whole = {(r.node_id, r.t): (r.flow, r.occupy, r.speed) for r in SP.read_cube(spark, str(tmp_path / "all.npz")).collect()}
    assert whole == {(v, t): tuple(cube[t, v]) for v in range(4) for t in range(20)}
    daily = SP.read_cube(spark, str(tmp_path / "day*.npy"), steps_per_file=10)
    assert {(r.node_id, r.t): (r.flow, r.occupy, r.speed) for r in daily.collect()} == whole
    following = SP.read_cube(spark, str(tmp_path / "day*.npy"))
    assert {(r.node_id, r.t): (r.flow, r.occupy, r.speed) for r in following.collect()} == whole
    with pytest.raises(ValueError, match="more than steps_per_file"):
        SP.read_cube(spark, str(tmp_path / "day*.npy"), steps_per_file=8)
    daily.write.parquet(str(tmp_path / "panel"))
    assert SP.read_panel(spark, str(tmp_path / "panel")).count() == 80


def test_timed_readings(spark):
    rows = [("A", 1, "2023-01-01 01:00:00", 2.0), ("A", 26, "2023-01-02 02:00:00", 3.0)]
    panel = SP.timed_panel(SP.inline_readings(spark, rows), "2023-01-01 00:00:00", 60)
    assert [tuple(r) for r in panel.orderBy("t").collect()] == [("A", 1, 2.0), ("A", 26, 3.0)]
    assert SP.inline_readings(spark, rows).schema == TIMED_READING_SCHEMA


def test_forecast_files(spark, tmp_path):
    forecast = spark.createDataFrame([(0, 1, 0.5, 0.25)], "node_id bigint, t bigint, prediction double, target double")
    base = Base(spark.createDataFrame([(0, 10.0, 2.0)], "node_id bigint, max_flow double, min_flow double"), 1)
    path = str(tmp_path / "saved")
    assert SF.save_forecast(forecast, path, base=base)
    assert tuple(SF.read_forecast(spark, path, "test").first()) == (0, 1, 6.0, 4.0)
    assert SF.save_forecast(forecast, path, denormalise=False, split="train")
    assert {r.split for r in SF.read_forecast(spark, path).collect()} == {"test", "train"}
    assert SF.read_forecast(spark, path).columns == ["node_id", "t", "prediction", "target", "split"]
    blocked = tmp_path / "file"
    blocked.write_text("x")
    assert SF.save_forecast(forecast, str(blocked / "below"), denormalise=False) is False


def test_checked_edges(spark, tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text('from,to,cost\n1,2,3.5\n4,5\n6,x,1.0\n7,8,9.0,10\n"2","3",1\n4,5,NaN\n6,,2.5\n8,9,-Inf\n')
    done = SE.checked_edges(spark, str(path))
    assert sorted(map(tuple, done.good.collect())) == [(1, 2, 3.5), (2, 3, 1.0)]
    assert sorted((r.reason, r.row) for r in done.rejected.collect()) == [
        ("malformed", "4,5"), ("malformed", "6,x,1.0"), ("malformed", "7,8,9.0,10"),
        ("missing", "6,,2.5"), ("not_finite", "4,5,NaN"), ("not_finite", "8,9,-Infinity"),
    ]
    assert {r.file for r in done.rejected.collect()} == {"edges.csv"}
    (tmp_path / "none.csv").write_text("from,to,cost\n")
    none = SE.checked_edges(spark, str(tmp_path / "none.csv"))
    assert none.good.isEmpty() and none.rejected.isEmpty()


def cells(df):
    return {(r.node_id, r.t): tuple(r)[2:] for r in df.collect()}


@pytest.mark.parametrize("save", [np.savez, np.savez_compressed, None])
def test_array_ranges(spark, tmp_path, save):
    """One large file is read by many tasks, a span opens only its ranges, and every reading of one DataFrame is whole."""
    cube = np.random.default_rng(1).uniform(size=(20, 4, 3)).astype("float32")
    name = "all.npz" if save else "all.npy"
    save(tmp_path / name, data=cube) if save else np.save(tmp_path / name, cube)
    df = SA.read_arrays(spark, str(tmp_path), steps_per_task=6)
    assert df.rdd.getNumPartitions() == (1 if save is np.savez_compressed else 4)
    want = {(v, t): tuple(map(float, cube[t, v])) for v in range(4) for t in range(20)}
    assert cells(df.where("t >= 7 and t < 9")) == {k: v for k, v in want.items() if 7 <= k[1] < 9}
    assert cells(df) == want
    part = SA.read_arrays(spark, str(tmp_path / name), columns=["speed"], span=(7, 14), steps_per_task=6)
    assert part.columns == ["node_id", "t", "speed"] and part.rdd.getNumPartitions() == (1 if save is np.savez_compressed else 2)
    assert cells(part) == {k: v[2:] for k, v in want.items() if 7 <= k[1] < 14}


def test_arrays_written_and_read(spark, tmp_path):
    cube = np.random.default_rng(2).uniform(size=(21, 5, 2))
    rows = [(v, t, *map(float, cube[t, v])) for t in range(21) for v in range(5)]
    panel = spark.createDataFrame(rows, "node_id bigint, t bigint, a double, b double").repartition(3)
    SA.write_arrays(panel, str(tmp_path / "out"), 5, 21, 8)
    assert sorted(f.name for f in (tmp_path / "out").iterdir()) == [f"steps-{k:012d}.npy" for k in (0, 8, 16)]
    assert np.array_equal(np.concatenate([np.load(f) for f in sorted((tmp_path / "out").iterdir())]), cube)
    back = SA.read_arrays(spark, str(tmp_path / "out"), features=["a", "b"], steps_per_task=3)
    assert cells(back) == {(v, t): (a, b) for v, t, a, b in rows}
    crossing = SA.read_arrays(spark, str(tmp_path / "out"), features=["a", "b"], columns=["b", "a"], span=(6, 19))
    assert cells(crossing) == {(v, t): (b, a) for v, t, a, b in rows if 6 <= t < 19}
    for bad in (panel.where("not (t = 4 and node_id = 2)"), panel.union(panel.limit(1)), panel.where("t <> 20")):
        with pytest.raises(Exception, match="densify"):
            SA.write_arrays(bad, str(tmp_path / "bad"), 5, 21, 8)
    with pytest.raises(ValueError, match="no features"):
        SA.read_arrays(spark, str(tmp_path / "out"), features=["a", "b"], columns=["c"])


def test_array_files_are_bounded_by_cells(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(SA, "CELLS_PER_FILE", 30)
    rows = [(v, t, float(v * 100 + t)) for v in range(10) for t in range(8)]
    SA.write_arrays(spark.createDataFrame(rows, "node_id long, t long, flow double"), str(tmp_path / "out"), 10, 8, 8)
    assert [np.load(f).shape for f in sorted((tmp_path / "out").glob("*.npy"))] == [(3, 10, 1), (3, 10, 1), (2, 10, 1)]
    assert sorted(map(tuple, SA.read_arrays(spark, str(tmp_path / "out"), features=["flow"]).collect())) == sorted(rows)
