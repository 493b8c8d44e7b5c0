"""Graph and panel read from an `events` table: users act as sensors, purchases that follow each other as roads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgraph.functions.scalars import step_of, steps_per_day, time_of_step
from flowgraph.operators.ordered import with_previous
from flowgraph.operators.panel import densify
from flowgraph.plans.sizing import Settled, sized_join
from flowgraph.schemas import Graph

TIME_INTERVAL = 60
DIVIDE_DAYS = (20, 10)
H = 6
# Nodes that a scan takes as a list.
LISTED_NODES = 1000


@dataclass(frozen=True)
class Calendar:
    """Start of the first day of a table, and the number of steps up to the end of its last day."""

    start: str
    n_steps: int


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def calendar(spark: SparkSession, sf_dir: str) -> Calendar:
    """The whole days that the events cover; one row reaches the driver."""
    ts = F.col("ts").cast("timestamp")
    first, last = F.to_date(F.min(ts)), F.to_date(F.max(ts))
    day, days = read_table(spark, sf_dir, "events").agg(first.cast("string"), F.datediff(last, first) + 1).first()
    return Calendar(f"{day or '1970-01-01'} 00:00:00", (days or 0) * steps_per_day(TIME_INTERVAL))


def event_readings(spark: SparkSession, sf_dir: str, days: Calendar | None = None) -> DataFrame:
    """(node_id, t, event_id, event_type, value) with the step index of each event."""
    start = (days or calendar(spark, sf_dir)).start
    events = read_table(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").alias("node_id"),
        step_of(F.col("ts"), start, TIME_INTERVAL).alias("t"),
        "event_id",
        "event_type",
        "value",
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select(F.col("user_id").alias("node_id")).distinct()


def edge_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src, dst, weight = mean gap in minutes + 1, n = how often; a purchase leads to the next one of the same day."""
    purchases = read_table(spark, sf_dir, "events").where("event_type = 'purchase'").select("ts", "event_id", "user_id")
    steps = with_previous(purchases, ["ts", "event_id"], ["ts", "user_id"])
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("prev_ts").cast("timestamp"))
    same_day = F.date_trunc("day", "ts") == F.date_trunc("day", "prev_ts")
    return (
        steps.where(same_day & (F.col("prev_user_id") != F.col("user_id")))
        .groupBy(F.col("prev_user_id").alias("src"), F.col("user_id").alias("dst"))
        .agg(F.avg(F.lit(1.0) + micros / F.lit(60_000_000.0)).alias("weight"), F.count("*").alias("n"))
    )


def road_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """All sensors and all edges."""
    return Graph.of(sensors(spark, sf_dir), edge_list(spark, sf_dir))


def recurring_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """All sensors, and the edges seen at least twice: a sparse graph with many isolated vertices."""
    return Graph.of(sensors(spark, sf_dir), edge_list(spark, sf_dir).where("n >= 2"))


def hub_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """All sensors and edges, and an edge from the sensor with most events (the smallest of them) to every other one."""
    counts = read_table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("hub")).agg(F.count("*").alias("n"))
    hub = counts.agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("src"))  # one row
    nodes = sensors(spark, sf_dir)
    to_all = nodes.select(F.col("node_id").alias("dst")).join(F.broadcast(hub), F.col("dst") != F.col("src")).select("src", "dst")
    return Graph.of(nodes, edge_list(spark, sf_dir).select("src", "dst").unionByName(to_all).distinct())


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node_id, t, flow = number of events of the node in the hour; dense."""
    days = calendar(spark, sf_dir)
    counts = event_readings(spark, sf_dir, days).select("node_id", "t", F.lit(1).cast("bigint").alias("flow"))
    return densify(counts, sensors(spark, sf_dir), days.n_steps)


def panel_part(
    spark: SparkSession, sf_dir: str, near: Settled, span: tuple[int, int] | None = None, days: Calendar | None = None
) -> DataFrame:
    """The rows of `panel` for the nodes in `near` and, with `span`, its steps. Events of other nodes and times are left out
    at the scan: times by a range of `ts`, nodes by their list while it has at most LISTED_NODES, else by a semi-join."""
    days = days or calendar(spark, sf_dir)
    events = read_table(spark, sf_dir, "events")
    low, high = span or (0, days.n_steps)
    low, high = max(low, 0), min(high, days.n_steps)
    edge = lambda t: time_of_step(F.lit(t), days.start, TIME_INTERVAL).cast(events.schema["ts"].dataType)
    inside = events.where((F.col("ts") >= edge(low)) & (F.col("ts") < edge(high)))
    if near.rows <= LISTED_NODES:
        inside = inside.where(F.col("user_id").isin([r.node_id for r in near.df.collect()]))
    else:
        inside = sized_join(inside, near.df.select(F.col("node_id").alias("user_id")), "user_id", near.rows, spread="event_id", how="left_semi")
    counts = inside.select(
        F.col("user_id").alias("node_id"), (step_of(F.col("ts"), days.start, TIME_INTERVAL) - low).alias("t"), F.lit(1).cast("bigint").alias("flow")
    )
    return densify(counts, near.df, max(high - low, 0)).withColumn("t", F.col("t") + low).where(F.col("t") >= low)


def feature_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node_id, t with three measures: flow = events, occupy = share of purchases, speed = mean value."""
    return (
        event_readings(spark, sf_dir)
        .groupBy("node_id", "t")
        .agg(
            F.count("*").cast("double").alias("flow"),
            F.avg((F.col("event_type") == "purchase").cast("double")).alias("occupy"),
            F.avg("value").alias("speed"),
        )
    )
