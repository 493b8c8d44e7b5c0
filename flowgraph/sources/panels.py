"""Panels from long tables and from array files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgraph.functions.scalars import parsed_time, step_of
from flowgraph.plans.sizing import settle, sized_join
from flowgraph.schemas import FEATURES, PANEL_SCHEMA, TIMED_READING_SCHEMA

STEPS_PER_CHUNK = 512


def read_panel(spark: SparkSession, path, file_format: str = "parquet") -> DataFrame:
    """A long table node_id, t, flow, occupy, speed."""
    if file_format == "csv":
        return spark.read.schema(PANEL_SCHEMA).option("header", True).csv(path)
    return spark.read.schema(PANEL_SCHEMA).format(file_format).load(path)


def timed_panel(readings: DataFrame, start: str, time_interval: int) -> DataFrame:
    """Readings src, timestamp text, flow -> node_id, t, flow."""
    ts = parsed_time(F.col("timestamp"))
    return readings.select(F.col("src").alias("node_id"), step_of(ts, start, time_interval).alias("t"), "flow")


def inline_readings(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, TIMED_READING_SCHEMA)


def _steps_in(content: bytes, key: str) -> int:
    """The first dimension of an array file, read from its header."""
    stream = io.BytesIO(content)
    if zipfile.is_zipfile(stream):
        stream = zipfile.ZipFile(stream).open(f"{key}.npy")
    else:
        stream.seek(0)
    major, _ = np.lib.format.read_magic(stream)
    read = np.lib.format.read_array_header_1_0 if major == 1 else np.lib.format.read_array_header_2_0
    return read(stream)[0][0]


def file_lengths(files: DataFrame, key: str) -> DataFrame:
    """path, steps: a row per array file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "steps": [_steps_in(c, key) for c in batch["content"]]})

    return files.select("path", "content").mapInPandas(run, "path string, steps bigint")


def read_cube(
    spark: SparkSession,
    path,
    *,
    key: str = "data",
    features: Sequence[str] = FEATURES,
    steps_per_file: int = 0,
) -> DataFrame:
    """Array files [step, node, feature] (.npz with member `key`, or .npy) -> long panel.

    Each file is one task's work, so a long series belongs into many files, for example one per day. The files follow
    each other in the order of their names, each from the step after the last one of the file before. With steps_per_file
    set, every file starts that many steps after the file before; a file with more steps is an error.
    """
    names = list(features)
    schema = "node_id bigint, t bigint, " + ", ".join(f"{n} double" for n in names)
    files = spark.read.format("binaryFile").load(path)
    lengths = settle(file_lengths(files, key))
    if steps_per_file:
        longer = lengths.df.where(F.col("steps") > steps_per_file).orderBy("path").first()
        if longer:
            raise ValueError(f"{longer.path} has {longer.steps} steps, more than steps_per_file = {steps_per_file}")
    # A row per file, without contents.
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    width = F.lit(steps_per_file) if steps_per_file else F.col("steps")
    firsts = lengths.df.select("path", F.coalesce(F.sum(width).over(before), F.lit(0)).cast("bigint").alias("first"))
    placed = sized_join(files.select("path", "content"), firsts, "path", lengths.rows, spread="path").select("first", "content")

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, content in zip(batch["first"], batch["content"]):
                loaded = np.load(io.BytesIO(content))
                cube = loaded[key] if hasattr(loaded, "files") else loaded
                nodes = cube.shape[1]
                for at in range(0, cube.shape[0], STEPS_PER_CHUNK):
                    part = cube[at : at + STEPS_PER_CHUNK]
                    frame = {
                        "node_id": np.tile(np.arange(nodes), len(part)),
                        "t": np.repeat(np.arange(at, at + len(part)) + int(first), nodes),
                    }
                    for position, name in enumerate(names):
                        frame[name] = part[:, :, position].astype("float64").ravel()
                    yield pd.DataFrame(frame)

    return placed.mapInPandas(decode, schema)
