"""Graph networks inside a block of steps, for operators beyond the broadcast bound.

The entries of a dealt operator and the rows of a block reach a task as one stream: the entries first, then the rows step by step (Spark sorts
them, and spills what does not fit). The entries are put down in the task's temporary folder and read again in pieces for every pass over them; a
step is some vectors with a place per node. All layers of a network run on them, so nothing moves between layers, a worker holds vectors of a
step and not rows of a block, and blocks may be long, which is how often the entries move.

Nulls are those of `propagate`: a product with a null is left out of a sum, a sum of none is null, and a node has a row after a pass where one of its
senders had one.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from flowgraph.operators.graph import Operator

# Entries that are read at once, and rows of a batch of results.
PIECE_ENTRIES = 1 << 18
BATCH_ROWS = 1 << 16

# Values with 0 where they are unknown, and which are known.
Vector = tuple[np.ndarray, np.ndarray]
# t, which nodes have a row, and the columns.
Step = tuple[int, np.ndarray, list[Vector]]


class Places:
    """The places of ids in a sorted array."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        span = int(ids[-1]) - int(ids[0]) + 1 if len(ids) else 0
        self.table = None
        if 0 < span <= 4 * len(ids) + 1024:
            self.table = np.full(span, -1, np.int32)
            self.table[ids - ids[0]] = np.arange(len(ids), dtype=np.int32)

    def of(self, wanted: np.ndarray) -> np.ndarray:
        """-1 where there is none."""
        if not len(self.ids):
            return np.full(len(wanted), -1, np.int32)
        if self.table is not None:
            inside = (wanted >= self.ids[0]) & (wanted <= self.ids[-1])
            return np.where(inside, self.table[np.where(inside, wanted - self.ids[0], 0)], -1)
        at = np.minimum(np.searchsorted(self.ids, wanted), len(self.ids) - 1)
        return np.where(self.ids[at] == wanted, at, -1).astype(np.int32)


def _numbers(column: pa.Array, fill) -> np.ndarray:
    return column.fill_null(fill).to_numpy(zero_copy_only=False)


class Edges:
    """The entries of a block, in a file. The nodes in them have the places of their sorted ids; the next place is that of the node without an id, and others
    follow for nodes that only the rows have."""

    def __init__(self, folder: str):
        self.path = os.path.join(folder, "entries")
        self.raw = open(self.path + "-raw", "w+b")
        self.receivers: list[np.ndarray] = []
        self.count = 0

    def add(self, batch: pa.RecordBatch) -> None:
        degree = batch.column("js").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        a, ends = 0, np.cumsum(degree)
        while a < len(degree):
            before = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, before + PIECE_ENTRIES, side="right")))
            self._put(batch.slice(a, b - a), degree[a:b])
            a = b

    def _put(self, rows: pa.RecordBatch, degree: np.ndarray) -> None:
        j, w = rows.column("js").flatten(), rows.column("ws").flatten()
        met = np.asarray(j.is_valid())
        run = np.repeat(np.arange(len(degree)), degree)[met]
        i = rows.column("node_id")
        named = np.asarray(i.is_valid())
        for part in (_numbers(i, 0), named, run, _numbers(j, 0)[met], _numbers(w, 0.0)[met], np.asarray(w.is_valid())[met]):
            np.save(self.raw, part)
        self.receivers.append(np.unique(_numbers(i, 0)[named]))
        self.count += 1

    def settle(self) -> None:
        """Once all entries are there: give the nodes their places."""
        ids = np.unique(np.concatenate(self.receivers)) if self.receivers else np.zeros(0, np.int64)
        self.places = Places(ids)
        strange = []
        for part in self._parts():
            sent = part[3]
            lost = self.places.of(sent) < 0
            if lost.any():
                strange.append(np.unique(sent[lost]))
        if strange:
            ids = np.union1d(ids, np.concatenate(strange))
            self.places = Places(ids)
        self.ids, self.receivers = ids, []
        self.nameless = len(ids)
        self.strangers: dict[int, int] = {}
        self.file = open(self.path, "w+b")
        for i, named, run, j, w, known in self._parts():
            at = np.where(named, self.places.of(i), self.nameless).astype(np.int32)
            starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.zeros(0, np.int64)
            j = self.places.of(j).astype(np.int32)
            own = np.flatnonzero(at[run] == j)
            for part in (at[run[starts]], starts, j, np.where(known, w, 0.0), np.zeros(0, bool) if known.all() else known, own):
                np.save(self.file, part)
        self.raw.close()
        os.unlink(self.path + "-raw")

    def _parts(self) -> Iterator[list[np.ndarray]]:
        self.raw.seek(0)
        for _ in range(self.count):
            yield [np.load(self.raw) for _ in range(6)]

    def pieces(self) -> Iterator[list[np.ndarray]]:
        """Per run of receivers: their places, where each one's entries begin, and of each entry the sender's place, the weight (0: null), whether it
        is known (empty: all are); and the entries from a node to itself."""
        self.file.seek(0)
        for _ in range(self.count):
            yield [np.load(self.file) for _ in range(6)]

    @property
    def size(self) -> int:
        return self.nameless + 1 + len(self.strangers)

    def place(self, ids: np.ndarray, named: np.ndarray) -> np.ndarray:
        """The places of rows; nodes without entries get new ones."""
        at = np.where(named, self.places.of(ids), self.nameless)
        for n in np.flatnonzero(at < 0):
            at[n] = self.strangers.setdefault(int(ids[n]), self.size)
        return at

    def names(self, at: np.ndarray) -> pa.Array:
        inside = np.minimum(at, max(0, self.nameless - 1))
        return pa.array(self.ids[inside] if self.nameless else np.zeros(len(at), np.int64), mask=at >= self.nameless)

    def spread(
        self, columns: Sequence[Vector], rows: np.ndarray, factor: float = 1.0, plus: Sequence[Vector] | None = None, flipped: bool = False
    ) -> tuple[list[Vector], np.ndarray]:
        """`propagate` of some columns of a step; with `flipped` by the transposed operator (without `plus`)."""
        n = len(rows)
        out = [(np.zeros(n), np.zeros(n, bool)) for _ in columns]
        reached = np.zeros(n, bool)
        inner = slice(0, self.nameless)
        everywhere = rows[inner].all()
        whole = [known[inner].all() and (plus is None or plus[c][1][inner].all()) for c, (_, known) in enumerate(columns)]
        for i, starts, j, w, weighed, own in self.pieces():
            if not len(i):
                continue
            if flipped:
                sender, receiver = np.repeat(i, np.diff(np.append(starts, len(j)))), j
                reached[receiver if everywhere else receiver[rows[sender]]] = True
            else:
                sender = j
                reached[i] = True if everywhere else np.logical_or.reduceat(rows[j], starts)
            for c, (x, known) in enumerate(columns):
                terms = x[sender] * w
                valid = None
                if not whole[c] or len(weighed):
                    valid = known[sender]
                    if len(weighed):
                        valid &= weighed
                    if plus is not None:
                        valid[own] &= plus[c][1][j[own]]
                    terms = np.where(valid, terms, 0.0)
                if flipped:
                    out[c][0][:] += np.bincount(receiver, terms, n)
                    out[c][1][receiver if valid is None else receiver[valid]] = True
                    continue
                out[c][0][i] = np.add.reduceat(terms, starts)
                out[c][1][i] = True if valid is None else np.logical_or.reduceat(valid, starts)
                if plus is not None:
                    at = j[own] if valid is None else j[own[valid[own]]]
                    # factor comes later
                    out[c][0][at] += plus[c][0][at] / factor
        if factor != 1.0:
            for x, _ in out:
                x *= factor
        return out, reached


# --- columns of a step ---------------------------------------------------------------------------------------------

def only(column: Vector, rows: np.ndarray) -> Vector:
    return np.where(rows, column[0], 0.0), column[1] & rows


def linear(columns: Sequence[Vector], weight, bias=None, act: bool = False) -> list[Vector]:
    """One column per column of `weight`, with `act` cut at zero; null where one of the inputs is."""
    known = columns[0][1].copy()
    for _, k in columns[1:]:
        known &= k
    out = []
    for c in range(len(weight[0])):
        value = columns[0][0] * weight[0][c]
        for (x, _), row in zip(columns[1:], weight[1:]):
            value += x * row[c]
        if bias is not None:
            value += bias[c]
        out.append((np.where(known, np.maximum(value, 0.0) if act else value, 0.0), known))
    return out


def less(a: Vector, b: Vector, factor: float = 1.0) -> Vector:
    """factor * a - b."""
    known = a[1] & b[1]
    return np.where(known, factor * a[0] - b[0], 0.0), known


def chebyshev(edges: Edges, columns: Sequence[Vector], rows: np.ndarray, order: int) -> tuple[list[list[Vector]], np.ndarray]:
    """`chebyshev_basis` of a step: the columns of each level, and the rows after the last pass."""
    levels = [list(columns)]
    for k in range(1, order + 1):
        sent, rows = edges.spread(levels[-1], rows)
        levels = [[only(x, rows) for x in level] for level in levels]
        levels.append([less(x, y, 2.0) for x, y in zip(sent, levels[k - 2])] if k > 1 else sent)
    return levels, rows


def clenshaw(edges: Edges, taps: Sequence[Vector], rows: np.ndarray) -> tuple[Vector, np.ndarray]:
    """`chebyshev_sum` of a step with one output column."""
    current, after = taps[-1], None
    for k in range(len(taps) - 2, -1, -1):
        rest = less(taps[k], after) if after else taps[k]
        before = current
        (current,), rows = edges.spread([current], rows, 2.0 if k else 1.0, [rest])
        after = before
    return current, rows


class History:
    """The last h rows of each node, and how many rows it had."""

    def __init__(self, h: int, columns: int):
        self.h = h
        self.past: list[list[Vector]] = [[(np.zeros(0), np.zeros(0, bool))] * h for _ in range(columns)]
        self.count = np.zeros(0, np.int64)

    def _fit(self, n: int) -> None:
        more = n - len(self.count)
        if more > 0:
            self.count = np.pad(self.count, (0, more))
            self.past = [[(np.pad(x, (0, more)), np.pad(k, (0, more))) for x, k in column] for column in self.past]

    def inputs(self, n: int) -> list[Vector]:
        """Per column the values before this row, oldest first."""
        self._fit(n)
        return [x for column in self.past for x in column]

    def full(self, n: int) -> np.ndarray:
        self._fit(n)
        return self.count >= self.h

    def push(self, rows: np.ndarray, columns: Sequence[Vector]) -> None:
        self._fit(len(rows))
        self.count += rows
        for c, column in enumerate(columns):
            moved = [*self.past[c][1:], column]
            # a node without a row keeps its history
            self.past[c] = moved if rows.all() else [(np.where(rows, x, y), np.where(rows, a, b)) for (x, a), (y, b) in zip(moved, self.past[c])]


# --- streams -----------------------------------------------------------------------------------------------------

def _steps(first: pa.RecordBatch | None, batches: Iterator[pa.RecordBatch], edges: Edges, columns: Sequence[str]) -> Iterator[Step]:
    waiting, current = [], None

    def step() -> Step:
        ids, named = (np.concatenate([w[n] for w in waiting]) for n in (0, 1))
        at = edges.place(ids, named)
        n = edges.size
        rows = np.zeros(n, bool)
        rows[at] = True
        twice = rows.sum() < len(at)
        made = []
        for c in range(len(columns)):
            values, valid = (np.concatenate([w[2][c][m] for w in waiting]) for m in (0, 1))
            x, known = np.zeros(n), np.zeros(n, bool)
            known[at[valid]] = True
            if twice:
                x = np.full(n, -np.inf)
                np.maximum.at(x, at[valid], values[valid])
                x[~known] = 0.0
            else:
                x[at] = np.where(valid, values, 0.0)
            made.append((x, known))
        return current, rows, made

    def cells():
        if first is not None:
            yield first
        yield from batches

    for batch in cells():
        if batch.num_rows and batch.column("kind")[0].as_py() == 0:
            raise RuntimeError("entries after rows")
        t = batch.column("t").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(t[1:] != t[:-1]) + 1), len(t)] if len(t) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if waiting and t[a] != current:
                yield step()
                waiting = []
            current = int(t[a])
            part = batch.slice(a, b - a)
            ids = part.column("node_id")
            waiting.append((_numbers(ids, 0), np.asarray(ids.is_valid()), [(_numbers(part.column(c), 0.0), np.asarray(part.column(c).is_valid())) for c in columns]))
    if waiting:
        yield step()


def in_blocks(
    frame: DataFrame, op: Operator, columns: Sequence[str], kernel: Callable[[Edges, Iterator[Step], int], Iterator], schema: str, nameless: bool = False
) -> DataFrame:
    """`kernel` of every block: it gets the entries of the dealt operator, the steps of `frame` (blk, t, node_id and `columns`) in order and the block, and yields
    steps in the columns of `schema` after blk, t, node_id; or, without these, tables. `nameless`: with the rows that have no node id."""
    if op.dealt is None or op.flipped:
        raise ValueError("in_blocks needs a dealt operator that is not transposed")
    # Empty, not null: Arrow's writer goes over a run of null lists again for every row.
    none = [F.array().cast(kind).alias(n) for n, kind in (("js", "array<bigint>"), ("ws", "array<double>"))]
    values = [f"v_{n}" for n in range(len(columns))]
    rows = frame if nameless else frame.where("node_id is not null")
    rows = rows.select(
        "blk", F.lit(1).alias("kind"), F.col("t").cast("bigint").alias("t"), "node_id", *[F.col(c).cast("double").alias(v) for c, v in zip(columns, values)],
        *none,
    )
    entries = op.dealt.select(
        "blk", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("t"), F.col("i").alias("node_id"), *[F.lit(None).cast("double").alias(v) for v in values], "js", "ws"
    )
    # Both lie by block, and so does their union: this sort is all that stands before the groups.
    stream = entries.union(rows).sortWithinPartitions("blk", "kind", "t")
    shape = to_arrow_schema(StructType.fromDDL(schema))
    plain = shape.names[:3] == ["blk", "t", "node_id"]

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blk = key[0].as_py()
        with tempfile.TemporaryDirectory() as folder:
            edges = Edges(folder)
            rest = None
            for batch in batches:
                sent = int(np.count_nonzero(batch.column("kind").to_numpy() == 0))
                if sent:
                    edges.add(batch.slice(0, sent))
                if sent < batch.num_rows:
                    rest = batch.slice(sent)
                    break
            if rest is None or not edges.count:
                return
            edges.settle()
            for made in kernel(edges, _steps(rest, batches, edges, values), blk):
                if not plain:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(made, shape.types)], shape.names)
                    continue
                t, reached, cells = made
                at = np.flatnonzero(reached)
                for a in range(0, len(at), BATCH_ROWS):
                    some = at[a : a + BATCH_ROWS]
                    fixed = [pa.array(np.full(len(some), x, np.int64)) for x in (blk, t)]
                    yield pa.RecordBatch.from_arrays([*fixed, edges.names(some), *[pa.array(x[some], mask=~known[some]) for x, known in cells]], shape.names)
            edges.file.close()

    return stream.groupBy("blk").applyInArrow(run, schema)


def plain_schema(columns: Sequence[str]) -> str:
    return "blk long, t long, node_id long, " + ", ".join(f"`{c}` double" for c in columns)
