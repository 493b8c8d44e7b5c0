"""Array files [step, node, feature] as a Spark data source: ranges of steps are read by offset, by many tasks.

`read_arrays` makes one partition per range of steps of one file, so a single large file is read by many tasks and nothing
travels but the rows. A span of steps picks the ranges before any of them is opened, and only the named features are decoded.
The span is an argument: Spark 4.1 keeps filters that a Python source has taken with the relation, so that a second query
on the same DataFrame would read the first one's range. `write_arrays` streams rows sorted by (t, node_id) into files of a fixed number of
steps, fewer than asked for where a file would exceed CELLS_PER_FILE cells; a task holds one record batch at a time.

A path is a folder or a file, local or a URI that pyarrow's file systems open. Files follow each other in the order of their
names. A compressed .npz member cannot be read by offset and is one partition.
"""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from flowgraph.schemas import FEATURES

STEPS_PER_TASK = 4_096
CELLS_PER_BATCH = 65_536
HEADER_READERS = 32
# A file is sorted in one task, so it gets fewer steps where the nodes are many.
CELLS_PER_FILE = 2_000_000


def _file_system(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        # Spark names local files file:/a/b, pyarrow file:///a/b.
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path


def _array_files(path: str) -> list[str]:
    from pyarrow import fs

    system, inside = _file_system(path)
    info = system.get_file_info(inside)
    if info.type == fs.FileType.File:
        return [inside]
    found = system.get_file_info(fs.FileSelector(inside))
    return sorted(i.path for i in found if i.is_file and i.path.endswith((".npy", ".npz")))


@dataclass(frozen=True)
class Member:
    """Where the numbers of one array file start, and their shape."""

    file: str
    shape: tuple[int, ...]
    dtype: str
    offset: int
    by_offset: bool


def _header(stream) -> tuple[tuple[int, ...], np.dtype]:
    major, _ = np.lib.format.read_magic(stream)
    read = np.lib.format.read_array_header_1_0 if major == 1 else np.lib.format.read_array_header_2_0
    shape, by_columns, dtype = read(stream)
    if by_columns or len(shape) != 3:
        raise ValueError(f"an array [step, node, feature] in row order is needed, not {shape}")
    return shape, dtype


def member_of(root: str, file: str, key: str) -> Member:
    """The header alone is read."""
    system, _ = _file_system(root)
    with system.open_input_file(file) as source:
        if not file.endswith(".npz"):
            shape, dtype = _header(source)
            return Member(file, shape, dtype.str, source.tell(), True)
        entry = zipfile.ZipFile(source).getinfo(f"{key}.npy")
        with zipfile.ZipFile(source).open(entry) as stream:
            shape, dtype = _header(stream)
            inside = stream.tell()
        # A stored member lies in the file as it is, behind a local header of 30 bytes, its name and its extra field.
        source.seek(entry.header_offset + 26)
        name, extra = np.frombuffer(source.read(4), "<u2").tolist()
        offset = entry.header_offset + 30 + name + extra + inside
        return Member(file, shape, dtype.str, offset, entry.compress_type == zipfile.ZIP_STORED)


@dataclass
class StepRange(InputPartition):
    """Steps [low, high) of a file whose first step is `first` in the whole panel."""

    member: Member
    first: int
    low: int
    high: int


class ArrayReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path, self.key = options["path"], options.get("key", "data")
        self.steps = int(options.get("stepspertask", STEPS_PER_TASK))
        self.features = options["features"].split(",")
        self.names = [n for n in schema.fieldNames() if n not in ("node_id", "t")]
        self.low = int(options.get("from", 0))
        self.high = int(options["until"]) if "until" in options else None

    def partitions(self) -> Sequence[InputPartition]:
        files = _array_files(self.path)
        with ThreadPoolExecutor(HEADER_READERS) as pool:
            members = list(pool.map(lambda f: member_of(self.path, f, self.key), files))
        ranges, first = [], 0
        for member in members:
            n = member.shape[0]
            low = max(self.low - first, 0)
            high = n if self.high is None else min(self.high - first, n)
            width = self.steps if member.by_offset else max(n, 1)
            ranges += [StepRange(member, first, at, min(at + width, high)) for at in range(low, high, width)]
            first += n
        return ranges

    def read(self, partition: StepRange) -> Iterator[pa.RecordBatch]:
        member = partition.member
        _, nodes, width = member.shape
        dtype = np.dtype(member.dtype)
        row = nodes * width * dtype.itemsize
        chunk = max(1, CELLS_PER_BATCH // max(nodes, 1))
        places = [self.features.index(n) for n in self.names]
        system, _ = _file_system(self.path)
        with system.open_input_file(member.file) as source:
            if member.by_offset:
                stream = source
                stream.seek(member.offset + partition.low * row)
            else:
                stream = zipfile.ZipFile(source).open(f"{self.key}.npy")
                _header(stream)
                for _ in range(partition.low):
                    stream.read(row)
            for at in range(partition.low, partition.high, chunk):
                steps = min(chunk, partition.high - at)
                data = stream.read(steps * row)
                if len(data) < steps * row:
                    raise ValueError(f"{member.file} ends before step {at + steps}")
                cube = np.frombuffer(data, dtype).reshape(steps, nodes, width)
                columns = [
                    np.tile(np.arange(nodes, dtype="int64"), steps),
                    np.repeat(np.arange(at, at + steps, dtype="int64") + partition.first, nodes),
                    *[cube[:, :, p].astype("float64").ravel() for p in places],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node_id", "t", *self.names])


@dataclass
class Written(WriterCommitMessage):
    moves: list[tuple[str, str]]


class ArrayWriter(DataSourceArrowWriter):
    """Writes under a name of its own and moves the files to their places on commit, so that a repeated task does no harm."""

    def __init__(self, options: dict, schema):
        self.path = options["path"]
        self.nodes, self.steps = int(options["nodes"]), int(options["stepsperfile"])
        self.total = int(options["nsteps"])
        self.names = [n for n in schema.fieldNames() if n not in ("node_id", "t")]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = _file_system(self.path)
        system.create_dir(root, recursive=True)
        moves, out, file, seen = [], None, -1, 0

        def finish():
            if out is not None:
                wanted = min(self.steps, self.total - file * self.steps) * self.nodes
                out.close()
                if seen != wanted:
                    raise ValueError(f"steps from {file * self.steps} have {seen} cells, not {wanted}: densify the panel first")

        for batch in iterator:
            t = batch.column("t").to_numpy()
            node = batch.column("node_id").to_numpy()
            values = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in self.names], axis=1).astype("<f8")
            home = t // self.steps
            cuts = [0, *(np.flatnonzero(np.diff(home)) + 1).tolist(), len(t)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if home[a] != file:
                    finish()
                    file, seen = int(home[a]), 0
                    moves.append((f"{root}/_{uuid.uuid4().hex}", f"{root}/steps-{file * self.steps:012d}.npy"))
                    out = system.open_output_stream(moves[-1][0])
                    length = min(self.steps, self.total - file * self.steps)
                    np.lib.format.write_array_header_1_0(
                        out, {"descr": "<f8", "fortran_order": False, "shape": (length, self.nodes, len(self.names))}
                    )
                place = (t[a:b] - file * self.steps) * self.nodes + node[a:b]
                if not np.array_equal(place, np.arange(seen, seen + b - a)):
                    raise ValueError("cells are missing, repeated or out of order: densify the panel first")
                out.write(values[a:b].tobytes())
                seen += b - a
        finish()
        return Written(moves)

    def commit(self, messages):
        system, _ = _file_system(self.path)
        for message in messages:
            for source, target in message.moves if message else []:
                system.move(source, target)

    def abort(self, messages):
        system, _ = _file_system(self.path)
        for message in messages:
            for source, _ in message.moves if message else []:
                system.delete_file(source)


class ArraySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "panel_arrays"

    def schema(self) -> str:
        names = self.options.get("columns") or self.options["features"]
        return "node_id bigint, t bigint" + "".join(f", `{n}` double" for n in names.split(",") if n)

    def reader(self, schema) -> DataSourceReader:
        return ArrayReader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return ArrayWriter(self.options, schema)


def read_arrays(
    spark: SparkSession,
    path: str,
    *,
    key: str = "data",
    features: Sequence[str] = FEATURES,
    columns: Sequence[str] | None = None,
    span: tuple[int, int] | None = None,
    steps_per_task: int = STEPS_PER_TASK,
) -> DataFrame:
    """Array files -> node_id, t and the wanted `columns` (default: all `features`, which name the last axis)
    in the half-open range of steps `span` (default: all)."""
    spark.dataSource.register(ArraySource)
    wanted = list(features if columns is None else columns)
    unknown = [c for c in wanted if c not in features]
    if unknown:
        raise ValueError(f"no features {unknown} among {list(features)}")
    reader = spark.read.format("panel_arrays").option("key", key).option("stepspertask", steps_per_task)
    reader = reader.option("features", ",".join(features)).option("columns", ",".join(wanted))
    if span is not None:
        reader = reader.option("from", span[0]).option("until", span[1])
    return reader.load(path)


def write_arrays(panel: DataFrame, path: str, n_nodes: int, n_steps: int, steps_per_file: int) -> None:
    """A dense panel (node_id 0..n_nodes-1, t 0..n_steps-1, features) -> .npy files of steps_per_file steps each, or of as many as
    CELLS_PER_FILE cells allow.

    Missing or repeated cells inside a file are an error. Each file is written by one task from sorted rows.
    """
    panel.sparkSession.dataSource.register(ArraySource)
    values = [c for c in panel.columns if c not in ("node_id", "t")]
    steps_per_file = max(1, min(steps_per_file, CELLS_PER_FILE // max(n_nodes, 1)))
    files = max(1, -(-n_steps // steps_per_file))
    home = F.floor(F.col("t") / F.lit(steps_per_file))
    placed = panel.select("node_id", "t", *[F.col(c).cast("double").alias(c) for c in values]).repartition(files, home)
    writer = placed.sortWithinPartitions("t", "node_id").write.format("panel_arrays").mode("append")
    writer = writer.option("nodes", n_nodes).option("nsteps", n_steps).option("stepsperfile", steps_per_file)
    writer.option("features", ",".join(values)).save(path)
