"""Saved forecasts."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgraph.operators.panel import Base
from flowgraph.plans.forecast import restore
from flowgraph.plans.sizing import cut
from flowgraph.schemas import FORECAST_SCHEMA

log = logging.getLogger(__name__)


def write_forecast(forecast: DataFrame, path: str, split: Column | str = "test", mode: str = "overwrite") -> None:
    """Parquet of node_id, t, prediction, target, one folder per split. Overwriting replaces the written splits only."""
    label = F.lit(split) if isinstance(split, str) else split
    rows = forecast.select("node_id", "t", "prediction", "target", label.alias("split"))
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("split").parquet(path)


def save_forecast(
    forecast: DataFrame, path: str, *, base: Base | None = None, denormalise: bool = True, split: str = "test"
) -> bool:
    """Write a normalised forecast, restored to the unit of the readings or as it is. A failed write is logged and
    reported by the result, not raised."""
    if denormalise and base is None:
        raise ValueError("restoring needs the base of the scaling")
    try:
        write_forecast(restore(forecast, base) if denormalise else forecast, path, split)
    except (PySparkException, Py4JError) as failure:
        log.warning("forecast not saved to %s: %s", path, failure)
        return False
    return True


def read_forecast(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """node_id, t, prediction, target[, split]; a filter on split reads one folder only."""
    rows = spark.read.schema(FORECAST_SCHEMA.add("split", "string")).parquet(path)
    if split is None:
        return rows
    return rows.where(F.col("split") == split).drop("split")


def write_ordered(df: DataFrame, path: str, keys: Sequence[str] = ("node_id", "t"), files: int | None = None) -> None:
    """Parquet in the order of `keys`: every file is sorted, and file n + 1 goes on where file n ends.

    The bounds of the files are drawn from a sample of the rows, so nothing is sorted in one task. Rows are written once
    before, as sampling would compute them twice. Without `files` the session's number of shuffle partitions is taken.
    """
    rows = cut(df)
    ranged = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("errorifexists").parquet(path)


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The rows of a table written by `write_ordered`, each with its place in the whole order, from 0. Only the files' row
    counts are added up, one row per file."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    part = F.regexp_extract("_file", r"part-(\d+)", 1).cast("bigint")
    before = Window.orderBy(part, "_file").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    starts = counts.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = rows.join(F.broadcast(starts), "_file")
    return placed.select(*[c for c in rows.columns if c not in ("_file", "_row")], (F.col("_start") + F.col("_row")).alias(position))
