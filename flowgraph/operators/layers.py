"""Graph layers as DataFrame plans: random-walk convolution, Chebyshev filter, attention.

Weights are small and enter the plan as literals. All layers keep `node_id` and the step keys, and carry the columns
named by `carry` from input to output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from flowgraph.functions.scalars import LEAKY_SLOPE, dot, linear, relu
from flowgraph.operators import inblock
from flowgraph.operators.graph import Operator
from flowgraph.operators.panel import lag_names, windows
from flowgraph.operators.propagate import chebyshev_basis, chebyshev_sum, met_in_block as networks_met, propagate, step_keys, tap_names
from flowgraph.plans.sizing import by_block, cut, sized_join

Matrix = list[list[float]]


# --- parameters ----------------------------------------------------------------------------------------------

@dataclass
class GcnParams:
    """weight[layer][input][output], bias[layer][output]."""

    weight: list[Matrix]
    bias: list[list[float]]


@dataclass
class ChebParams:
    """weight[layer][order][input][output], bias[layer][output]; a missing bias counts as 0."""

    weight: list[list[Matrix]]
    bias: list[list[float] | None]
    normalize: bool = True

    @property
    def order(self) -> int:
        return len(self.weight[0]) - 1


@dataclass
class GatParams:
    """heads[head][input][hidden] with head_bias[head][hidden], then out[heads*hidden][output] with out_bias."""

    heads: list[Matrix]
    head_bias: list[list[float]]
    out: Matrix
    out_bias: list[float] = field(default_factory=list)


Params = GcnParams | ChebParams | GatParams


def init_gcn(in_c: int, hid_c: int, out_c: int, seed: int = 0) -> GcnParams:
    """Uniform within 1/sqrt(inputs), weights and biases alike."""
    rng = np.random.default_rng(seed)
    shapes = [(in_c, hid_c), (hid_c, out_c)]
    bounds = [1.0 / np.sqrt(i) for i, _ in shapes]
    return GcnParams(
        [rng.uniform(-b, b, s).tolist() for b, s in zip(bounds, shapes)],
        [rng.uniform(-b, b, s[1]).tolist() for b, s in zip(bounds, shapes)],
    )


def init_cheb(in_c: int, hid_c: int, out_c: int, order: int, seed: int = 0) -> ChebParams:
    """Normal with the Xavier deviation of a (order+1, 1, in, out) tensor; zero bias."""
    rng = np.random.default_rng(seed)
    weight = []
    for i, o in [(in_c, hid_c), (hid_c, out_c)]:
        # Fan of a tensor of this shape: second dimension (1) in, first dimension out, each times in * out.
        deviation = np.sqrt(2.0 / (i * o + (order + 1) * i * o))
        weight.append(rng.normal(0.0, deviation, (order + 1, i, o)).tolist())
    return ChebParams(weight, [[0.0] * hid_c, [0.0] * out_c])


def init_gat(in_c: int, hid_c: int, out_c: int, n_heads: int, seed: int = 0) -> GatParams:
    """Standard normal weights and biases."""
    rng = np.random.default_rng(seed)
    return GatParams(
        rng.normal(size=(n_heads, in_c, hid_c)).tolist(),
        rng.normal(size=(n_heads, hid_c)).tolist(),
        rng.normal(size=(n_heads * hid_c, out_c)).tolist(),
        rng.normal(size=out_c).tolist(),
    )


def _tensors(params: Params) -> dict[tuple[int, str], np.ndarray]:
    """All tensors as (layer, kind) -> array with axes (head or order, row, column)."""
    if isinstance(params, GatParams):
        return {
            (0, "weight"): np.array(params.heads),
            (0, "bias"): np.array(params.head_bias)[:, None, :],
            (1, "weight"): np.array(params.out)[None],
            (1, "bias"): np.array(params.out_bias)[None, None],
        }
    found = {}
    for layer, w in enumerate(params.weight):
        w = np.array(w)
        found[(layer, "weight")] = w if w.ndim == 3 else w[None]
        if params.bias[layer] is not None:
            found[(layer, "bias")] = np.array(params.bias[layer])[None, None]
    return found


def parameter_table(spark: SparkSession, params: Params) -> DataFrame:
    """(layer, kind, tap, row, col, value): how a model is saved. A model has some hundred values at most."""
    rows = [
        (layer, kind, int(k), int(r), int(c), float(a[k, r, c]))
        for (layer, kind), a in _tensors(params).items()
        for k, r, c in np.ndindex(a.shape)
    ]
    return spark.createDataFrame(rows, "layer int, kind string, tap int, row int, col int, value double")


def params_from_table(table: DataFrame, model: str) -> Params:
    cells: dict[tuple[int, str], dict[tuple[int, int, int], float]] = {}
    for r in table.collect():
        cells.setdefault((r.layer, r.kind), {})[(r.tap, r.row, r.col)] = r.value
    arrays = {}
    for key, values in cells.items():
        a = np.zeros(tuple(1 + max(k[d] for k in values) for d in range(3)))
        for at, v in values.items():
            a[at] = v
        arrays[key] = a
    if model == "gat":
        return GatParams(
            arrays[0, "weight"].tolist(),
            arrays[0, "bias"][:, 0].tolist(),
            arrays[1, "weight"][0].tolist(),
            arrays[1, "bias"][0, 0].tolist(),
        )
    biases = [arrays[layer, "bias"][0, 0].tolist() if (layer, "bias") in arrays else None for layer in (0, 1)]
    if model == "gcn":
        return GcnParams([arrays[layer, "weight"][0].tolist() for layer in (0, 1)], biases)
    if model == "cheb":
        return ChebParams([arrays[layer, "weight"].tolist() for layer in (0, 1)], biases)
    raise ValueError(f"model must be gcn, cheb or gat, not {model!r}")


# --- convolution ---------------------------------------------------------------------------------------------

def project(
    frame: DataFrame, columns: Sequence[str], weight: Matrix, bias: Sequence[float] | None, out: Sequence[str],
    carry: Sequence[str] = (), act: Callable[[Column], Column] | None = None,
) -> DataFrame:
    values = linear(columns, weight, bias)
    values = [act(v) for v in values] if act else values
    return frame.select(*step_keys(frame), "node_id", *carry, *[v.alias(o) for v, o in zip(values, out, strict=True)])


def names(prefix: str, n: int) -> list[str]:
    return [f"{prefix}_{c}" for c in range(1, n + 1)]


def gcn_layer(
    frame: DataFrame, op: Operator, columns: Sequence[str], weight: Matrix, bias: Sequence[float], out: Sequence[str],
    carry: Sequence[str] = (),
) -> DataFrame:
    """relu(P (X W + b))."""
    spread = propagate(project(frame, columns, weight, bias, out, carry), op, out, carry=carry)
    return spread.select(*step_keys(spread), "node_id", *carry, *[relu(F.col(o)).alias(o) for o in out])


def gcn_forward(
    frame: DataFrame, op: Operator, params: GcnParams, columns: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """Two layers; `op` is the random-walk operator. The output column is `prediction`. With a dealt operator both run in the block."""
    if networks_met(frame, op):
        return _forward_in_block(frame, op, params, columns, carry)
    hidden = names("h", len(params.bias[0]))
    first = gcn_layer(frame, op, columns, params.weight[0], params.bias[0], hidden, carry)
    return gcn_layer(first, op, hidden, params.weight[1], params.bias[1], ["prediction"], carry)


def cheb_layer(
    frame: DataFrame, op: Operator, columns: Sequence[str], weight: list[Matrix], bias: Sequence[float] | None,
    out: Sequence[str], carry: Sequence[str] = (),
) -> DataFrame:
    """relu(sum over k of T_k(L) X W_k + b)."""
    order = len(weight) - 1
    basis = chebyshev_basis(frame, op, columns, order, carry)
    taps = [c for level in tap_names(columns, order) for c in level]
    stacked = [row for level in weight for row in level]
    return project(basis, taps, stacked, bias, out, carry, relu)


def cheb_forward(
    frame: DataFrame, op: Operator, params: ChebParams, columns: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    if networks_met(frame, op):
        return _forward_in_block(frame, op, params, columns, carry)
    hidden = names("h", len(params.weight[0][0][0]))
    first = cheb_layer(frame, op, columns, params.weight[0], params.bias[0], hidden, carry)
    return cheb_layer(first, op, hidden, params.weight[1], params.bias[1], ["prediction"], carry)


def _forward_in_block(
    frame: DataFrame, op: Operator, params: GcnParams | ChebParams, columns: Sequence[str], carry: Sequence[str]
) -> DataFrame:
    """Both layers of `gcn_forward` or `cheb_forward` with a dealt operator."""
    if not op.anchored:
        raise ValueError("a network needs an anchored operator")

    def kernel(edges, steps, blk):
        for t, rows, cells in steps:
            value, kept = cells[: len(columns)], cells[len(columns) :]
            for weight, bias in zip(params.weight, params.bias):
                if isinstance(params, GcnParams):
                    sent, rows = edges.spread(inblock.linear(value, weight, bias), rows)
                    value = [(np.maximum(x, 0.0), known) for x, known in sent]
                elif len(weight) > 1 and len(weight[0][0]) < len(value) and rows[: edges.nameless].all() and all(known[: edges.nameless].all() for _, known in value):
                    # with nothing missing the weights may come first, so fewer columns are filtered
                    ends = [inblock.linear(value, tap) for tap in weight]
                    sums = [inblock.clenshaw(edges, [end[c] for end in ends], rows) for c in range(len(ends[0]))]
                    rows = sums[0][1]
                    value = inblock.linear([x for x, _ in sums], np.eye(len(sums)).tolist(), bias, act=True)
                else:
                    levels, rows = inblock.chebyshev(edges, value, rows, len(weight) - 1)
                    value = inblock.linear([x for level in levels for x in level], [row for level in weight for row in level], bias, act=True)
                kept = [inblock.only(x, rows) for x in kept]
            yield t, rows, [*kept, *[inblock.only(x, rows) for x in value]]

    return inblock.in_blocks(frame, op, [*columns, *carry], kernel, inblock.plain_schema([*carry, "prediction"]))


@dataclass(frozen=True)
class SeriesNetwork:
    """The pieces of `series_forward` on the steps of a block (`inblock`)."""

    params: GcnParams | ChebParams
    h: int
    block: int

    @property
    def first(self) -> Matrix:
        return self.params.weight[0] if isinstance(self.params, GcnParams) else [row for tap in self.params.weight[0] for row in tap]

    @property
    def last(self) -> list[Matrix]:
        return [self.params.weight[1]] if isinstance(self.params, GcnParams) else self.params.weight[1]

    def hidden(self, edges, steps, blk: int):
        """Per target step of the block: t, the rows with a full history, the series, the inputs and the first layer."""
        taps = 1 if isinstance(self.params, GcnParams) else self.params.order + 1
        history = inblock.History(self.h, taps)
        for t, rows, (series, *_) in steps:
            if isinstance(self.params, GcnParams):
                filtered, rows = edges.spread([series], rows)
            else:
                levels, rows = inblock.chebyshev(edges, [series], rows, self.params.order)
                filtered = [level[0] for level in levels]
            if t // self.block == blk:
                inputs = history.inputs(len(rows))
                full = rows & history.full(len(rows))
                first = inblock.linear(inputs, self.first, self.params.bias[0], act=True)
                yield t, full, inblock.only(series, full), inputs, [inblock.only(x, full) for x in first]
            history.push(rows, filtered)

    def output(self, edges, rows: np.ndarray, hidden) -> tuple:
        """The last layer before its bias, and its rows."""
        ends = [inblock.linear(hidden, weight)[0] for weight in self.last]
        if isinstance(self.params, GcnParams):
            (out,), rows = edges.spread(ends, rows)
            return out, rows
        return inblock.clenshaw(edges, ends, rows)

    def scored(self, edges, steps, blk: int):
        shift = self.params.bias[1][0] if self.params.bias[1] is not None else 0.0
        for t, rows, series, _, hidden in self.hidden(edges, steps, blk):
            out, rows = self.output(edges, rows, hidden)
            yield t, rows, [inblock.only(series, rows), *inblock.linear([out], [[1.0]], [shift], act=True)]


def series_forward(
    rows: DataFrame, op: Operator, params: GcnParams | ChebParams, h: int, block: int, column: str,
    cut_to: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """`gcn_forward` or `cheb_forward` over the history of a series, with less traffic.

    The graph filter and the shift in time commute, so the series itself is filtered, one column instead of h, before
    the history is cut; the second layer multiplies by its weights before it filters. `rows` comes from `with_halo`;
    `column` is kept in the result next to `prediction`. `cut_to` drops target steps nobody asked for. With a dealt operator
    everything runs in the block.
    """
    if networks_met(rows, op):
        if not op.anchored:
            raise ValueError("a network needs an anchored operator")
        scored = SeriesNetwork(params, h, block).scored
        return cut_to(inblock.in_blocks(rows, op, [column], scored, inblock.plain_schema([column, "prediction"])))
    if isinstance(params, GcnParams):
        filtered = propagate(rows, op, [column], carry=[column], out=[f"{column}_k0"])
        taps, weights, biases = [f"{column}_k0"], [params.weight[0]], params.bias
        last = [params.weight[1]]
    else:
        filtered = chebyshev_basis(rows, op, [column], params.order, carry=[column])
        taps = [names_k[0] for names_k in tap_names([column], params.order)]
        weights, biases, last = params.weight[0], params.bias, params.weight[1]
    wide = cut_to(windows(filtered, h, block, lags={tap: f"{tap}_x" for tap in taps}))
    inputs = [lag for tap in taps for lag in lag_names(h, f"{tap}_x")]
    stacked = [row for level in weights for row in level]
    hidden = names("h", len(stacked[0]))
    first = project(wide, inputs, stacked, biases[0], hidden, [column], relu)
    ends = [f"z_{k}" for k in range(len(last))]
    second = first.select(
        *step_keys(first), "node_id", column, *[linear(hidden, w)[0].alias(z) for w, z in zip(last, ends)]
    )
    if isinstance(params, GcnParams):
        out = propagate(second, op, ends, carry=[column])
    else:
        out = chebyshev_sum(second, op, [[z] for z in ends], ["z_0"], carry=[column])
    shift = biases[1][0] if biases[1] is not None else 0.0
    return out.select(
        *step_keys(out), "node_id", column, relu(F.col("z_0") + F.lit(float(shift))).alias("prediction")
    )


# --- attention -----------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Heads:
    """A set of attention heads over the last `h` values of a series (h = 0: the value of the step itself)."""

    weight: list[Matrix]
    h: int
    block: int

    @property
    def columns(self) -> list[list[str]]:
        return [[f"g_{a}_{c}" for c in range(1, len(w[0]) + 1)] for a, w in enumerate(self.weight, 1)]

    @property
    def flat(self) -> list[str]:
        return [c for head in self.columns for c in head]

    def inputs(self, series: str, step: Column) -> list[Column]:
        """The feature columns of a step, read from the packed series of a block by position."""
        if self.h == 0:
            return [F.get(series, step)]
        return [F.get(series, step - back) for back in range(self.h, 0, -1)]

    def project(self, series: str, step: Column) -> list[Column]:
        inputs = self.inputs(series, step)
        return [value for w in self.weight for value in linear(inputs, w)]


def packed(rows: DataFrame, column: str, keep: str | None = None) -> DataFrame:
    """One row per block and node of a dense panel: steps, `series` and `kept` in step order, at most block + halo
    values each. `kept` is what attention hands through; without `keep` it is the series."""
    values = [F.col(column).alias("series")] + ([F.col(keep).alias("kept")] if keep else [])
    cells = rows.groupBy("blk", "node_id").agg(F.array_sort(F.collect_list(F.struct("t", *values))).alias("cells"))
    kept = [F.col("cells.kept").alias("kept")] if keep else []
    return cells.select(
        "blk", "node_id", F.col("cells.t").alias("steps"), F.col("cells.series").alias("series"), *kept
    )


# The state of a softmax over some of a node's neighbours, for all steps of a block: per head and step the largest score so far
# and the sum of exponentials below it, and per head column and step their weighted sum. Two states merge by rescaling both
# to the larger maximum, so neighbours are seen once, in any order and split over any tasks.
_STATE = "blk long, i long, steps array<long>, kept array<double>, state array<double>"


def _matrix(column) -> np.ndarray:
    """Rows of equal length as a matrix; null becomes NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _merged(top: np.ndarray, z: np.ndarray, sums: np.ndarray, starts: np.ndarray, widths: Sequence[int]):
    """The states of runs of rows as one state each. top, z: rows x steps x heads; sums: rows x steps x head columns."""
    best = np.maximum.reduceat(top, starts)
    run = np.repeat(np.arange(len(starts)), np.diff(np.concatenate([starts, [len(top)]])))
    scale = np.where(top > -np.inf, np.exp(top - np.where(best > -np.inf, best, 0.0)[run]), 0.0)
    return best, np.add.reduceat(z * scale, starts), np.add.reduceat(sums * np.repeat(scale, widths, axis=2), starts)


def _batches(key: np.ndarray, starts: np.ndarray, kept: list, steps: list, state: np.ndarray) -> pa.RecordBatch:
    width = state.shape[1]
    offsets = pa.array(np.arange(len(starts) + 1, dtype=np.int32) * width, pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(key[starts, 0]), pa.array(key[starts, 1]), *(c.take(pa.array(starts)) for c in (steps, kept)),
         pa.ListArray.from_arrays(offsets, pa.array(state.reshape(-1)))],
        ["blk", "i", "steps", "kept", "state"],
    )


def _key(batch, *names: str) -> np.ndarray:
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])


# Rows of an Arrow batch whose head columns are spread out over the steps at once; they take some hundred times the bytes of the packed rows.
PIECE_ROWS = 1024


def pieces(batches):
    """The batches cut into runs of at most PIECE_ROWS rows."""
    for batch in batches:
        for a in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(a, PIECE_ROWS)


def head_values(series: np.ndarray, places: np.ndarray, heads: Heads) -> np.ndarray:
    """rows x places x head columns: the head columns at places of each packed series."""
    weight = np.concatenate([np.array(w, np.float64) for w in heads.weight], axis=1)
    if heads.h == 0:
        return series[:, places, None] * weight[0]
    past = np.lib.stride_tricks.sliding_window_view(series, heads.h, axis=1)[:, places - heads.h]
    return past @ weight


def _places(steps: np.ndarray, blk: int, heads: Heads) -> np.ndarray:
    """Positions of a packed row that are target steps of its own block and have a full history."""
    at = np.arange(len(steps))
    return at[(steps >= blk * heads.block) & (at >= heads.h)]


def softmax_states(met: DataFrame, heads: Heads) -> DataFrame:
    """One state per run of rows of the same receiver and block (columns blk, i, node_id, w, start, series_i, series, and on one row of each
    also steps, kept)."""
    widths = [len(c) for c in heads.columns]
    ends = np.cumsum([0, *widths])

    def run(batches):
        for batch in pieces(batches):
            key = _key(batch, "blk", "i")
            lengths = batch.column("series").value_lengths().to_numpy()
            begin = batch.column("start").to_numpy()
            cuts = [*_runs(key[:, 0], lengths), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(a, b - a)
                places = _places(begin[a] + np.arange(lengths[a]), int(key[a, 0]), heads)
                own = key[a:b]
                starts = _runs(own[:, 0], own[:, 1])
                run = np.repeat(np.arange(len(starts)), np.diff([*starts, b - a]))
                # each node's head columns once, however many pairs it is in
                _, once, node = np.unique(part.column("node_id").to_numpy(), return_index=True, return_inverse=True)
                ours = head_values(_matrix(part.column("series_i").take(pa.array(starts))), places, heads)[run]
                theirs = head_values(_matrix(part.column("series").take(pa.array(once))), places, heads)[node]
                w = np.asarray(part.column("w").to_numpy(zero_copy_only=False), np.float64)[:, None]
                scores = np.stack([np.einsum("rpc,rpc->rp", ours[:, :, x:y], theirs[:, :, x:y]) * w for x, y in zip(ends[:-1], ends[1:])], axis=2)
                # no entry (an anchor row has no weight) and a score of zero do not take part
                live = ~np.isnan(scores) & (scores != 0)
                top = np.where(live, scores, -np.inf)
                sums = np.where(np.isnan(theirs), 0.0, theirs)
                with_kept = np.flatnonzero(np.asarray(part.column("kept").is_valid()))
                carrier = starts.copy()
                carrier[run[with_kept]] = with_kept
                state = np.concatenate(_merged(top, live.astype(np.float64), sums, starts, widths), axis=2).reshape(len(starts), -1)
                yield _batches(own, carrier, part.column("kept"), part.column("steps"), state)

    return met.select("blk", "i", "node_id", "w", "start", "steps", "kept", "series_i", "series").mapInArrow(run, _STATE)


def merged_states(states: DataFrame, heads: Heads) -> DataFrame:
    """One state per receiver and block; the rows of one must be in one task, next to each other."""
    widths, count = [len(c) for c in heads.columns], len(heads.weight)
    cells = 2 * count + sum(widths)

    def merge(table: pa.Table):
        batch = table.combine_chunks().to_batches()[0]
        key = _key(batch, "blk", "i")
        lengths = batch.column("state").value_lengths().to_numpy()
        cuts = [*_runs(lengths), len(key)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(a, b - a)
            state = _matrix(part.column("state")).reshape(b - a, -1, cells)
            own = key[a:b]
            starts = _runs(own[:, 0], own[:, 1])
            done = np.concatenate(_merged(state[:, :, :count], state[:, :, count : 2 * count], state[:, :, 2 * count :], starts, widths), axis=2)
            # one row of a receiver has what is the same for all its neighbours
            with_kept = np.flatnonzero(np.asarray(part.column("kept").is_valid()))
            carrier = starts.copy()
            carrier[np.searchsorted(starts, with_kept, side="right") - 1] = with_kept
            yield _batches(own, carrier, part.column("kept"), part.column("steps"), done.reshape(len(starts), -1))

    def run(batches):
        waiting = None
        for batch in pieces(batches):
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if waiting is None else pa.concat_tables([waiting, table])
            # the last receiver may go on in the next batch
            key = _key(table, "blk", "i")
            last = int(_runs(key[:, 0], key[:, 1])[-1])
            if last:
                yield from merge(table.slice(0, last))
            waiting = pa.Table.from_batches(list(merge(table.slice(last))))
        if waiting is not None:
            yield from waiting.to_batches()

    return states.mapInArrow(run, _STATE)


def column_sums(blocks: DataFrame, heads: Heads) -> DataFrame:
    """blk, everyone: per target step of a block the number of nodes with values, and their sum, for each head column in turn."""

    def run(batches):
        for whole in batches:
            sums: dict[tuple[int, int], np.ndarray] = {}
            for batch in pieces([whole]):
                blk = batch.column("blk").to_numpy()
                lengths = batch.column("steps").value_lengths().to_numpy()
                cuts = [*_runs(blk, lengths), len(blk)]
                for a, b in zip(cuts[:-1], cuts[1:]):
                    part = batch.slice(a, b - a)
                    places = _places(np.asarray(part.column("steps")[0].values.to_numpy()), int(blk[a]), heads)
                    values = head_values(_matrix(part.column("series")), places, heads)
                    known = ~np.isnan(values)
                    both = np.concatenate([known.sum(0), np.where(known, values, 0.0).sum(0)], axis=1).reshape(-1)
                    sums[int(blk[a]), len(both)] = sums.get((int(blk[a]), len(both)), 0.0) + both
            for (block, size), both in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, block)), pa.array(np.arange(size)), pa.array(both.astype(np.float64))], ["blk", "at", "x"]
                )

    parts = blocks.select("blk", "steps", "series").mapInArrow(run, "blk long, at long, x double")
    summed = parts.repartition("blk").groupBy("blk", "at").agg(F.sum("x").alias("x"))
    return summed.groupBy("blk").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda c: c["x"]).alias("everyone"))


# Entries that one group of `met_in_block` handles, doubles of scores that leave a block at once, and doubles that are spread out at once.
GROUP_ENTRIES = 4_000_000
GROUP_SCORES = 2_000_000
CHUNK_CELLS = 1 << 17


@dataclass(frozen=True)
class Block:
    """The packed rows of one block as arrays, nodes in order: the target steps, per node and target step the head columns (0 where unknown) and
    the value handed through, and the mean of the known head columns of all nodes."""

    ids: np.ndarray
    steps: np.ndarray
    values: np.ndarray
    kept: np.ndarray | None
    mean: np.ndarray

    @classmethod
    def of(cls, nodes: pa.Table, heads: Heads) -> "Block":
        steps = nodes.column("steps").combine_chunks()
        flat = steps.flatten().to_numpy()
        first, last = int(flat.min()), int(flat.max())
        cells = np.repeat(np.arange(len(steps)), steps.value_lengths().to_numpy()), flat - first
        # a node without an id counts in the mean, but no entry reaches it: it comes last
        order = pc.sort_indices(nodes.column("node_id"), null_placement="at_end").to_numpy()

        def matrix(name):
            dense = np.full((len(steps), last - first + 1), np.nan)
            dense[cells] = nodes.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return dense[order]

        every = np.arange(first, last + 1)
        places = _places(every, nodes.column("blk")[0].as_py(), heads)
        values = head_values(matrix("series"), places, heads)
        known = ~np.isnan(values)
        values[~known] = 0.0
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = values.sum(0) / known.sum(0)
        kept = matrix("kept")[:, places] if "kept" in nodes.column_names else None
        return cls(np.sort(nodes.column("node_id").drop_null().to_numpy()), every[places], values, kept, mean)

    @property
    def cells(self) -> int:
        """Head columns of a node."""
        return self.values[0].size

    def at(self, rows: np.ndarray) -> np.ndarray:
        """The head columns of some nodes."""
        return self.values[rows]

    def find(self, ids: pa.Array) -> np.ndarray:
        """The rows of nodes; -1 where there is none."""
        wanted = ids.fill_null(0).to_numpy(zero_copy_only=False)
        if not len(self.ids):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(self.ids, wanted), len(self.ids) - 1)
        return np.where((self.ids[at] == wanted) & ids.is_valid().to_numpy(zero_copy_only=False), at, -1)


class SeriesBlock:
    """The packed series of one block as a matrix of nodes and steps, which take a fraction of the memory of their head columns: these are made for the
    nodes that are asked for, as often as they are (0 where unknown)."""

    def __init__(self, blk: int, heads: Heads, nodes: int):
        self.heads, self.base, self.rows = heads, (blk - 1) * heads.block, 0
        self.blk, self.low, self.high = blk, 2 * heads.block, -1
        self.named, self.series = np.zeros(nodes + 1, np.int64), None

    def add(self, batch: pa.RecordBatch) -> None:
        batch = batch.filter(pc.and_(batch.column("node_id").is_valid(), pc.greater(pc.list_value_length(batch.column("steps")), 0)))
        n = batch.num_rows
        if not n:
            return
        at = batch.column("steps").flatten().to_numpy() - self.base
        low, high = int(at.min()), int(at.max())
        if low < 0 or high >= 2 * self.heads.block:
            raise ValueError("a packed row reaches beyond its block and the one before")
        self.low, self.high = min(self.low, low), max(self.high, high)
        while self.rows + n > len(self.named):
            self.named = np.concatenate([self.named, np.zeros(len(self.named), np.int64)])
            if self.series is not None:
                self.series = np.concatenate([self.series, np.empty_like(self.series)])
        if self.series is None:
            # as wide as the first rows; wider only if others reach further back
            self.left = low
            self.series = np.empty((len(self.named), 2 * self.heads.block - low))
        if low < self.left:
            self.series = np.concatenate([np.full((len(self.named), self.left - low), np.nan), self.series], axis=1)
            self.left = low
        held = self.series[self.rows : self.rows + n]
        held[:] = np.nan
        run = np.repeat(np.arange(n), batch.column("steps").value_lengths().to_numpy())
        held[run, at - self.left] = batch.column("series").flatten().to_numpy(zero_copy_only=False)
        self.named[self.rows : self.rows + n] = batch.column("node_id").to_numpy()
        self.rows += n

    def settle(self) -> None:
        self.order = np.argsort(self.named[: self.rows], kind="stable")
        self.ids = self.named[: self.rows]
        self.sorted = inblock.Places(self.ids[self.order])
        every = np.arange(self.base + self.low, self.base + self.high + 1)
        self.places = _places(every, self.blk, self.heads)
        self.steps = every[self.places]
        self.cells = len(self.places) * len(self.heads.flat)

    def at(self, rows: np.ndarray) -> np.ndarray:
        seen = slice(self.low - self.left, self.high + 1 - self.left)
        values = head_values(self.series[rows, seen], self.places, self.heads)
        values[np.isnan(values)] = 0.0
        return values

    def find(self, ids: pa.Array) -> np.ndarray:
        at = self.sorted.of(ids.fill_null(0).to_numpy(zero_copy_only=False))
        return np.where((at >= 0) & np.asarray(ids.is_valid()), self.order[np.maximum(at, 0)] if self.rows else -1, -1)


@dataclass(frozen=True)
class Entries:
    """The entries of receivers: those of row `i[r]` of a block begin at `starts[r]` and come from its rows `j`."""

    i: np.ndarray
    j: np.ndarray
    w: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table, block: Block | SeriesBlock) -> "Entries":
        js, ws = rows.column("js").combine_chunks(), rows.column("ws").combine_chunks()
        run = np.repeat(block.find(rows.column("i").combine_chunks()), js.value_lengths().to_numpy())
        j = block.find(js.flatten())
        w = ws.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        met = (run >= 0) & (j >= 0)
        run = run[met]
        starts = _runs(run)
        # an anchor row has no weight: its score is zero
        return cls(run[starts], j[met], np.nan_to_num(w[met]), starts)

    def scores(self, block: Block | SeriesBlock, heads: Heads):
        """Per run of receivers a..b, of CHUNK_CELLS or one receiver: a, b, where each one's entries begin, x, the entries' scores by step and head (zero: takes no
        part), and the senders' head columns."""
        ends = np.cumsum([0, *[len(c) for c in heads.columns]])
        most = max(1, CHUNK_CELLS // max(1, block.cells))
        border = np.append(self.starts, len(self.j))
        a = 0
        while a < len(self.i):
            b = max(a + 1, int(np.searchsorted(border, border[a] + most, side="right")) - 1)
            x, y = border[a], border[b]
            theirs = block.at(self.j[x:y])
            ours = np.repeat(block.at(self.i[a:b]), np.diff(border[a : b + 1]), axis=0)
            each = [np.einsum("epc,epc->ep", ours[:, :, p:q], theirs[:, :, p:q]) for p, q in zip(ends[:-1], ends[1:])]
            yield a, b, border[a:b] - x, x, np.stack(each, axis=2) * self.w[x:y, None, None], theirs
            a = b


def met_in_block(
    blocks: DataFrame, op: Operator, heads: Heads, most: int, kernel: Callable[[int, Block, Entries], dict[str, pa.Array]], schema: str
) -> DataFrame:
    """`kernel` of every block of packed rows and the entries of a dealt operator. No row travels along an entry: the entries, packed by receiver, meet the
    rows of their block as one group. Beyond `most` entries they are dealt over slices by a hash of the receiver and the rows are repeated once
    per slice, so a group holds about `most` entries and the nodes of a block of the step layout, however many entries there are."""
    slices = max(1, -(-op.rows // most))
    entries = op.dealt.where("i is not null").withColumn("slice", F.pmod(F.xxhash64("i"), F.lit(slices)))
    rows = blocks.where(F.size("steps") > 0).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint"))))
    empty = to_arrow_schema(blocks.sparkSession.createDataFrame([], schema).schema).empty_table()

    def run(key, sent: pa.Table, nodes: pa.Table) -> pa.Table:
        if not sent.num_rows or not nodes.num_rows:
            return empty
        block = Block.of(nodes, heads)
        met = Entries.of(sent, block) if len(block.steps) else None
        if met is None or not len(met.i):
            return empty
        return pa.table(kernel(key[0].as_py(), block, met))

    return entries.groupBy("blk", "slice").cogroup(rows.groupBy("blk", "slice")).applyInArrow(run, schema)


def met_in_stream(blocks: DataFrame, op: Operator, heads: Heads, kernel: Callable[[int, SeriesBlock, Entries], dict[str, pa.Array]], schema: str) -> DataFrame:
    """`kernel` of every block of packed rows and runs of receivers with their entries. The rows of a block reach its task first and are held as a matrix; the
    entries of the dealt operator follow and are handled as they come, GROUP_SCORES scores at once, so their number takes no memory."""
    shape = to_arrow_schema(blocks.sparkSession.createDataFrame([], schema).schema)
    lists = {"steps": "array<bigint>", "series": "array<double>", "js": "array<bigint>", "ws": "array<double>"}
    none = {n: F.array().cast(kind).alias(n) for n, kind in lists.items()}
    rows = blocks.select("blk", F.lit(0).alias("kind"), "node_id", "steps", "series", none["js"], none["ws"])
    entries = op.dealt.where("i is not null").select("blk", F.lit(1).alias("kind"), F.col("i").alias("node_id"), none["steps"], none["series"], "js", "ws")
    # Both lie by block, and so does their union.
    stream = rows.union(entries).sortWithinPartitions("blk", "kind")
    nodes, per_entry = op.nodes, heads.block * len(heads.weight)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ready = SeriesBlock(key[0].as_py(), heads, nodes), False
        for batch in batches:
            held = int(np.count_nonzero(batch.column("kind").to_numpy() == 0))
            if held:
                if ready:
                    raise RuntimeError("rows after entries")
                block.add(batch.slice(0, held))
            if held == batch.num_rows:
                continue
            if not ready:
                if not block.rows:
                    return
                block.settle()
                ready = True
            if not len(block.steps):
                return
            sent = batch.slice(held)
            ends = np.cumsum(sent.column("js").value_lengths().to_numpy())
            a = 0
            while a < len(ends):
                before = ends[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(ends, before + max(1, GROUP_SCORES // per_entry), side="right")))
                part = pa.Table.from_batches([sent.slice(a, b - a).rename_columns(["blk", "kind", "i", *lists])])
                met = Entries.of(part, block)
                if len(met.i):
                    yield from pa.table(kernel(block.blk, block, met), shape).to_batches()
                a = b

    return stream.groupBy("blk").applyInArrow(run, schema)


def _lists(rows: np.ndarray, lengths: np.ndarray | None = None) -> pa.Array:
    """Rows of numbers as lists, NaN as null; with `lengths`, that many rows follow each other in one list."""
    width = rows[0].size if len(rows) else 0
    lengths = np.ones(len(rows), np.int64) if lengths is None else lengths
    flat = np.ascontiguousarray(rows).reshape(-1)
    offsets = np.concatenate([[0], np.cumsum(lengths * width)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, from_pandas=flat.dtype.kind == "f"))


# --- attention weights -------------------------------------------------------------------------------------------

def _packed_pairs(names: Sequence[str]) -> str:
    return "blk long, i long, steps array<long>, js array<long>, " + ", ".join(f"{n} array<double>" for n in names)


def attention_pairs(blocks: DataFrame, op: Operator, heads: Heads) -> DataFrame:
    """A row per receiver and block: (blk, i), its target steps, its neighbours `js`, and per head the scores `s_<a>`, for each neighbour one per
    step, one neighbour after the other. A zero score, and those of the anchor row of i, are null."""
    names = [f"s_{a}" for a in range(1, len(heads.weight) + 1)]
    if op.dealt is not None and not op.flipped:

        def kernel(blk: int, block: SeriesBlock, met: Entries) -> dict[str, pa.Array]:
            scores = np.empty((len(heads.weight), len(met.j), len(block.steps)))
            for _, _, _, x, part, _ in met.scores(block, heads):
                scores[:, x : x + len(part)] = np.moveaxis(part, 2, 0)
            scores[scores == 0] = np.nan
            degree = np.diff(np.append(met.starts, len(met.j)))
            return {
                "blk": pa.array(np.full(len(met.i), blk)), "i": pa.array(block.ids[met.i]), "steps": _lists(np.tile(block.steps, (len(met.i), 1))),
                "js": _lists(block.ids[met.j][:, None], degree), **{n: _lists(head, degree) for n, head in zip(names, scores)},
            }

        return met_in_stream(blocks, op, heads, kernel, _packed_pairs(names))
    at_i = blocks.select("blk", F.col("node_id").alias("i"), "steps", F.col("series").alias("series_i"))
    matrix = op.df.select("i", F.col("j").alias("node_id"), "w")
    sent = sized_join(blocks.select("blk", "node_id", "series"), matrix, "node_id", op.rows, spread="blk")
    met = sent.join(at_i, ["blk", "i"])
    ends = np.cumsum([0, *[len(c) for c in heads.columns]])

    def run(batches):
        for batch in pieces(batches):
            blk, lengths = batch.column("blk").to_numpy(), batch.column("steps").value_lengths().to_numpy()
            cuts = [*_runs(blk, lengths), len(blk)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(a, b - a)
                steps = np.asarray(part.column("steps")[0].values.to_numpy())
                places = _places(steps, int(blk[a]), heads)
                if not len(places):
                    continue
                ours, theirs = (head_values(_matrix(part.column(c)), places, heads) for c in ("series_i", "series"))
                w = np.asarray(part.column("w").to_numpy(zero_copy_only=False), np.float64)[:, None]
                scores = [np.einsum("rpc,rpc->rp", ours[:, :, x:y], theirs[:, :, x:y]) * w for x, y in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("blk"), part.column("i"), part.column("node_id"), _lists(np.tile(steps[places], (b - a, 1))), *[_lists(np.where(s != 0, s, np.nan)) for s in scores]],
                    ["blk", "i", "node_id", "steps", *names],
                )

    schema = "blk long, i long, node_id long, steps array<long>, " + ", ".join(f"{n} array<double>" for n in names)
    cells = met.select("blk", "i", "node_id", "w", "steps", "series_i", "series").mapInArrow(run, schema)
    gathered = cells.groupBy("blk", "i").agg(F.first("steps").alias("steps"), F.collect_list(F.struct("node_id", *names)).alias("cells"))
    return gathered.select("blk", "i", "steps", F.col("cells.node_id").alias("js"), *[F.flatten(f"cells.{n}").alias(n) for n in names])


def _by_pair(batches, columns: Sequence[str]):
    """Rows of `attention_pairs` with the same number of steps, where each one's neighbours begin, and the columns as neighbours x steps."""
    for batch in pieces(batches):
        steps = batch.column("steps").value_lengths().to_numpy()
        cuts = [*_runs(steps), len(steps)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(a, b - a)
            degree = part.column("js").value_lengths().to_numpy()
            cells = [np.asarray(part.column(c).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, steps[a]) for c in columns]
            yield part, degree, cells


def attention_weights(pairs: DataFrame, heads: Heads) -> DataFrame:
    """`attention_pairs` with the weights alpha_<a> in place of the scores; a node without live pairs has none: its row is uniform over all nodes."""
    scores = [f"s_{a}" for a in range(1, len(heads.weight) + 1)]
    names = [f"alpha_{a}" for a in range(1, len(heads.weight) + 1)]

    def run(batches):
        for part, degree, cells in _by_pair(batches, scores):
            starts, run = np.cumsum(degree) - degree, np.repeat(np.arange(len(degree)), degree)
            shares = []
            for s in cells:
                top = np.maximum.reduceat(np.where(np.isnan(s), -np.inf, s), starts)
                e = np.exp(s - np.where(top > -np.inf, top, 0.0)[run])
                shares.append(e / np.add.reduceat(np.where(np.isnan(e), 0.0, e), starts)[run])
            same = [part.column(c) for c in ("blk", "i", "steps", "js")]
            yield pa.RecordBatch.from_arrays([*same, *[_lists(x, degree) for x in shares]], ["blk", "i", "steps", "js", *names])

    return pairs.select("blk", "i", "steps", "js", *scores).mapInArrow(run, _packed_pairs(names))


def pair_totals(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j) and per column of `attention_pairs` or `attention_weights` the number of its values `live_<column>` and their sum, over all steps.

    Steps are summed up before anything moves; the sums of a block travel packed by receiver.
    """

    def run(batches):
        for part, degree, cells in _by_pair(batches, columns):
            arrays = [part.column("i"), part.column("js")]
            for x in cells:
                known = ~np.isnan(x)
                live = known.sum(1)
                arrays += [_lists(live[:, None], degree), _lists(np.where(live > 0, np.where(known, x, 0.0).sum(1), np.nan)[:, None], degree)]
            yield pa.RecordBatch.from_arrays(arrays, ["i", "js", *named])

    named = [n for c in columns for n in (f"live_{c}", c)]
    kinds = ", ".join(f"live_{c} array<long>, {c} array<double>" for c in columns)
    summed = pairs.select("i", "steps", "js", *columns).mapInArrow(run, f"i long, js array<long>, {kinds}").repartition("i")
    rows = summed.select("i", F.inline(F.arrays_zip(F.col("js").alias("j"), *named)))
    return rows.groupBy("i", "j").agg(*[F.sum(n).alias(n) for n in named])


# --- attention layers -------------------------------------------------------------------------------------------

def attend(
    blocks: DataFrame, op: Operator, heads: Heads, bias: Sequence[Sequence[float]],
    act: Callable[[np.ndarray], np.ndarray] | None = None, out: Matrix | None = None, layout: str = "node",
) -> DataFrame:
    """(blk, node_id, steps, kept, series_<c>): softmax-weighted mean of the neighbours' head columns plus bias at the target steps of
    every block, packed like `blocks`; with `out`, these columns times that matrix.

    `op` is an anchored symmetric adjacency. Where all scores of a node are zero its weights are uniform over all nodes of
    the step. Every neighbour is visited once: the softmax is a state that merges (see above). With layout="step" all rows of
    a block are in one place, so states move by block; otherwise by block and receiver. With a dealt operator entries meet the rows of
    their block as one group (`met_in_block`), and no pair or state moves; `blocks` is then partitioned by block, as `dealt` leaves the entries.
    """
    if op.dealt is not None:
        return _attend_in_block(blocks, op, heads, bias, act, out)
    by = ["blk"] if layout == "step" else ["blk", "i"]
    # The rows are few and their pairs many: with a number of its own the shuffle is not coalesced by the size of the rows.
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = by_block(blocks, heads.block) if layout == "step" else blocks.repartition(parts, "blk", "node_id")
    extra = F.col("kept" if "kept" in blocks.columns else "series").alias("kept")
    at_i = blocks.select("blk", F.col("node_id").alias("i"), F.get("steps", F.lit(0)).alias("start"), F.col("series").alias("series_i"), "steps", extra)
    matrix = op.df.select("i", F.col("j").alias("node_id"), "w")
    paired = sized_join(at_i.sortWithinPartitions("blk", "i"), matrix, "i", op.rows, spread="blk")
    # what is the same for all neighbours of a node travels with its anchor row
    first = F.col("w").isNull() & (F.col("i") == F.col("node_id"))
    paired = paired.select("blk", "i", "node_id", "w", "start", "series_i", *[F.when(first, F.col(c)).alias(c) for c in ("steps", "kept")])
    # the hash join keeps the order of its left side, so a node's neighbours mostly follow each other; if not, it has more states
    met = paired.join(blocks.select("blk", "node_id", "series").hint("shuffle_hash"), ["blk", "node_id"])
    states = softmax_states(met, heads)
    everyone = column_sums(blocks, heads)
    states = states.repartition(*by).sortWithinPartitions(*[F.col(c) for c in ("blk", "i")], F.col("kept").isNull())
    merged = merged_states(states, heads)
    widths, count = [len(c) for c in heads.columns], len(heads.weight)
    columns = sum(widths)
    shift = np.array([b for head in bias for b in head], np.float64)
    names_out = [f"series_{c}" for c in range(1, (len(out[0]) if out else columns) + 1)]

    def run(batches):
        for batch in pieces(batches):
            key = _key(batch, "blk", "i")
            lengths = batch.column("state").value_lengths().to_numpy()
            cuts = [*_runs(key[:, 0], lengths), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(a, b - a)
                if not lengths[a]:
                    continue
                state = _matrix(part.column("state")).reshape(b - a, -1, 2 * count + columns)
                steps = np.asarray(part.column("steps")[0].values.to_numpy())
                places = _places(steps, int(key[a, 0]), heads)
                total = _matrix(part.column("everyone").slice(0, 1)).reshape(len(places), 2 * columns)
                with np.errstate(divide="ignore", invalid="ignore"):
                    mean = total[:, columns:] / total[:, :columns]
                    value = state[:, :, 2 * count :] / np.repeat(state[:, :, count : 2 * count], widths, axis=2)
                value = np.where(np.repeat(state[:, :, count : 2 * count], widths, axis=2) > 0, value, mean) + shift
                value = act(value) if act else value
                value = value @ np.array(out, np.float64) if out else value
                kept = _matrix(part.column("kept"))[:, places]
                offsets = pa.array(np.arange(b - a + 1, dtype=np.int32) * len(places), pa.int32())

                def lists(rows):
                    flat = np.ascontiguousarray(rows).reshape(-1)
                    return pa.ListArray.from_arrays(offsets, pa.array(flat, from_pandas=flat.dtype.kind == "f"))

                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[a:b, 0]), pa.array(key[a:b, 1]), lists(np.tile(steps[places], (b - a, 1))), lists(kept), *(lists(value[:, :, c]) for c in range(value.shape[2]))],
                    ["blk", "node_id", "steps", "kept", *names_out],
                )

    return merged.join(everyone, "blk").mapInArrow(run, _attended(names_out))


def _attended(names_out: Sequence[str]) -> str:
    return "blk long, node_id long, steps array<long>, kept array<double>, " + ", ".join(f"{n} array<double>" for n in names_out)


def _attend_in_block(
    blocks: DataFrame, op: Operator, heads: Heads, bias: Sequence[Sequence[float]],
    act: Callable[[np.ndarray], np.ndarray] | None, out: Matrix | None,
) -> DataFrame:
    """`attend` with a dealt operator."""
    widths, count = [len(c) for c in heads.columns], len(heads.weight)
    shift = np.array([b for head in bias for b in head], np.float64)
    names_out = [f"series_{c}" for c in range(1, (len(out[0]) if out else sum(widths)) + 1)]

    def kernel(blk: int, block: Block, met: Entries) -> dict[str, pa.Array]:
        result = np.empty((len(met.i), len(block.steps), len(names_out)))
        for a, b, starts, _, scores, theirs in met.scores(block, heads):
            live = scores != 0
            _, z, sums = _merged(np.where(live, scores, -np.inf), live.astype(np.float64), theirs, starts, widths)
            z = np.repeat(z, widths, axis=2)
            with np.errstate(divide="ignore", invalid="ignore"):
                value = np.where(z > 0, sums / z, block.mean) + shift
            value = act(value) if act else value
            result[a:b] = value @ np.array(out, np.float64) if out else value
        return {
            "blk": pa.array(np.full(len(met.i), blk)), "node_id": pa.array(block.ids[met.i]), "steps": _lists(np.tile(block.steps, (len(met.i), 1))),
            "kept": _lists(block.kept[met.i]), **{n: _lists(result[:, :, c]) for c, n in enumerate(names_out)},
        }

    rows = blocks.select("blk", "node_id", "steps", "series", F.col("kept" if "kept" in blocks.columns else "series").alias("kept"))
    return met_in_block(rows, op, heads, GROUP_ENTRIES, kernel, _attended(names_out))


def unpacked(blocks: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(blk, t, node_id, ...): a row per step of packed rows, with the array columns under new names."""
    cells = F.arrays_zip(F.col("steps").alias("t"), *[F.col(c).alias(name) for c, name in columns.items()])
    rows = blocks.select("blk", "node_id", F.explode(cells).alias("_cell"))
    return rows.select("blk", "_cell.t", "node_id", *[F.col(f"_cell.{name}").alias(name) for name in columns.values()])


def _leaky(x: np.ndarray) -> np.ndarray:
    return np.where(x >= 0, x, LEAKY_SLOPE * x)


def _attended_step(edges, values: list[np.ndarray], rows: np.ndarray, heads: Heads, shift: np.ndarray):
    """Attention in a step: from the head columns of its nodes (NaN: unknown) the weighted means of the neighbours' plus bias, and which nodes have one."""
    known = [~np.isnan(x) & rows for x in values]
    values = [np.where(k, x, 0.0) for x, k in zip(values, known)]
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = [x.sum() / k.sum() for x, k in zip(values, known)]
    out = [np.full(len(rows), np.nan) for _ in values]
    met = np.zeros(len(rows), bool)
    ends = np.cumsum([0, *[len(c) for c in heads.columns]])
    for i, starts, j, w, _, _ in edges.pieces():
        if not len(i):
            continue
        run = np.repeat(i, np.diff(np.append(starts, len(j))))
        present = rows[run] & rows[j] & (run != edges.nameless)
        if not present.all():
            run, j, w = run[present], j[present], w[present]
            if not len(run):
                continue
            starts = _runs(run)
            i = run[starts]
        degree = np.diff(np.append(starts, len(j)))
        met[i] = True
        for a, b in zip(ends[:-1], ends[1:]):
            theirs = [values[c][j] for c in range(a, b)]
            scores = sum(values[c][run] * x for c, x in zip(range(a, b), theirs)) * w
            # an anchor entry has no weight, and a score of zero does not take part
            live = scores != 0
            top = np.maximum.reduceat(np.where(live, scores, -np.inf), starts)
            e = np.where(live, np.exp(scores - np.repeat(np.where(top > -np.inf, top, 0.0), degree)), 0.0)
            z = np.add.reduceat(e, starts)
            for c, x in zip(range(a, b), theirs):
                with np.errstate(divide="ignore", invalid="ignore"):
                    out[c][i] = np.where(z > 0, np.add.reduceat(e * x, starts) / z, mean[c]) + shift[c]
    return out, met


def _gat_in_block(rows: DataFrame, op: Operator, params: GatParams, heads: Heads, column: str) -> DataFrame:
    """`gat_forward` with a dealt operator."""
    weight = np.concatenate([np.array(w, np.float64) for w in params.heads], axis=1)
    shift = np.array([b for head in params.head_bias for b in head], np.float64)
    matrix, end = np.array(params.out, np.float64), Heads([[[1.0]]], 0, heads.block)

    def kernel(edges, steps, blk):
        history = inblock.History(heads.h, 1)
        for t, rows, (series, *_) in steps:
            if t >= blk * heads.block:
                past = np.stack([np.where(known, x, np.nan) for x, known in history.inputs(len(rows))], axis=1)
                full = rows & history.full(len(rows))
                hidden, met = _attended_step(edges, list(np.ascontiguousarray((past @ weight).T)), full, heads, shift)
                (last,) = (_leaky(np.stack(hidden, axis=1)) @ matrix).T
                last, met = _attended_step(edges, [last], met, end, np.array(params.out_bias, np.float64))
                value = _leaky(last[0])
                yield t, met, [series, (value, ~np.isnan(value))]
            history.push(rows, [series])

    return inblock.in_blocks(rows, op, [column], kernel, inblock.plain_schema([column, "prediction"]), nameless=True)


def gat_forward(
    rows: DataFrame, op: Operator, params: GatParams, h: int, block: int, column: str,
    cut_to: Callable[[DataFrame], DataFrame] = lambda df: df, layout: str = "node",
) -> DataFrame:
    """All heads in one pass, leaky relu, an output attention layer, leaky relu. `rows` comes from `with_halo`; `column`
    is kept in the result next to `prediction`. Steps stay packed by block from the readings to the result; with a dealt operator both layers
    run in the block, step by step."""
    heads, end = Heads(params.heads, h, block), Heads([[[1.0]]], 0, block)
    if networks_met(rows, op):
        return cut_to(_gat_in_block(rows, op, params, heads, column))
    blocks = cut(packed(rows, column))
    hidden = cut(attend(blocks, op, heads, params.head_bias, _leaky, params.out, layout).withColumnRenamed("series_1", "series"))
    last = attend(hidden, op, end, [params.out_bias], _leaky, layout=layout)
    return cut_to(unpacked(last, {"kept": column, "series_1": "prediction"}))
