"""Training on Spark: each step is one plan that ends in a handful of sums; the driver only updates the weights.

For a filter network (one tap P, or the Chebyshev taps of L) the graph filter is applied to the series once, before
training. In a step only single columns travel along edges: the second layer multiplies by its weights before it
filters, and because <T h, d> = <h, T' d> the error is filtered back instead of the hidden layer being kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgraph.functions.scalars import linear, relu, total
from flowgraph.operators import inblock
from flowgraph.operators.graph import Operator
from flowgraph.operators.layers import ChebParams, GcnParams, SeriesNetwork, names
from flowgraph.operators.metrics import LOSS_SCALE
from flowgraph.operators.panel import BATCH_STEPS, batch_shuffled, lag_names, packed_series, packed_windows, windows, within
from flowgraph.operators.propagate import chebyshev_basis, chebyshev_sum, propagate, tap_names
from flowgraph.plans.forecast import block_for, fitted, layout_for, model_rows, network_block, operator_for
from flowgraph.plans.sizing import broadcast_rows, by_block, cut
from flowgraph.schemas import Graph

FilterParams = GcnParams | ChebParams

# The usual settings of the Adam update.
LEARNING_RATE = 1e-3
BETAS = (0.9, 0.999)
EPSILON = 1e-8
EPOCHS = 2


# --- inputs --------------------------------------------------------------------------------------------------

def taps_of(params: FilterParams) -> list[str]:
    if isinstance(params, GcnParams):
        return ["y_k0"]
    return [level[0] for level in tap_names(["y"], params.order)]


def input_names(params: FilterParams, h: int) -> list[str]:
    return [lag for tap in taps_of(params) for lag in lag_names(h, f"{tap}_x")]


def training_rows(
    panel: DataFrame, graph: Graph, op: Operator, params: FilterParams, h: int, span: tuple[int, int]
) -> DataFrame:
    """(blk, t, node_id, y, filtered history columns) of the target steps in `span`; independent of the weights."""
    filtered, block = filtered_rows(panel, graph, op, params, h, span)
    return with_inputs(filtered, params, h, block, span)


def filtered_rows(
    panel: DataFrame, graph: Graph, op: Operator, params: FilterParams, h: int, span: tuple[int, int]
) -> tuple[DataFrame, int]:
    """(blk, t, node_id, y, a column per tap) with the halo of every block, and the block size."""
    rows, block = model_rows(panel, graph, params, h, span, block_for(graph, h))
    op = fitted(op, rows, layout_for(graph), block)
    if isinstance(params, GcnParams):
        return propagate(rows, op, ["y"], carry=["y"], out=["y_k0"]), block
    return chebyshev_basis(rows, op, ["y"], params.order, carry=["y"]), block


def with_inputs(filtered: DataFrame, params: FilterParams, h: int, block: int, span: tuple[int, int]) -> DataFrame:
    wide = windows(filtered, h, block, lags={tap: f"{tap}_x" for tap in taps_of(params)})
    return within(wide, span).select("blk", "t", "node_id", "y", *input_names(params, h))


@dataclass(frozen=True)
class Series:
    """(blk, t, node_id, y) with the halo of every block, from which steps beyond the broadcast bound start, the block size and the span of target steps."""

    df: DataFrame
    block: int
    span: tuple[int, int]


def settled_rows(
    panel: DataFrame, graph: Graph, op: Operator, params: FilterParams, h: int, span: tuple[int, int], whole: bool = True
) -> tuple[DataFrame | Series, Operator]:
    """`training_rows` that every step can start from, and the operator fitted to them. The series and its taps are written, packed
    by block and node, and the history is read from them anew in each step, which moves and stores h times less and sorts nothing; with
    whole=False, for steps that read a few of the rows each, the cut history is written."""
    layout = layout_for(graph)
    if whole and layout == "step" and op.rows > broadcast_rows(graph.edges.sparkSession):
        # Steps filter in the block, so the series alone is written.
        block = network_block(graph, h, op.rows)
        written = cut(packed_series(model_rows(panel, graph, params, h, span, block)[0], ["y"]))
        cells = F.inline(F.arrays_zip(F.col("steps").alias("t"), "y"))
        return Series(by_block(written, block).select("blk", "node_id", cells), block, span), fitted(op, written, layout, block)
    if not whole:
        rows = cut(training_rows(panel, graph, op, params, h, span))
        return rows, fitted(op, rows, layout, block_for(graph, h))
    filtered, block = filtered_rows(panel, graph, op, params, h, span)
    # Written rows have lost their partitioning.
    taps = taps_of(params)
    written = cut(packed_series(filtered, ["y", *taps]))
    placed = by_block(written, block) if layout == "step" else written.repartition("node_id", "blk")
    wide = within(packed_windows(placed, h, block, ["y"], {tap: f"{tap}_x" for tap in taps}), span)
    return wide.select("blk", "t", "node_id", "y", *input_names(params, h)), fitted(op, written, layout, block)


# --- gradient ------------------------------------------------------------------------------------------------

def _first_layer(params: FilterParams) -> list[list[float]]:
    return params.weight[0] if isinstance(params, GcnParams) else [row for tap in params.weight[0] for row in tap]


def _second_layer(params: FilterParams) -> list[list[float]]:
    """Per tap the weights of the hidden columns."""
    taps = [params.weight[1]] if isinstance(params, GcnParams) else params.weight[1]
    return [[row[0] for row in tap] for tap in taps]


def _bias(params: FilterParams, layer: int) -> list[float]:
    width = len(_first_layer(params)[0]) if layer == 0 else 1
    return params.bias[layer] if params.bias[layer] is not None else [0.0] * width


def filter_gradient(rows: DataFrame | Series, op: Operator, params: FilterParams, h: int) -> DataFrame:
    """The sums a training step needs, in rows (part, g_1..g_m).

    Part p < inputs: sum of input p times the first-layer error of each hidden column. Then the same for its bias, one
    part per tap with hidden column times filtered error, and a last part with the sums of the output error, the
    squared error, and the number of cells. Cells without a target or input do not count.
    """
    if isinstance(rows, Series):
        return _gradient_in_block(rows, op, params, h)
    inputs = input_names(params, h)
    first, second = _first_layer(params), _second_layer(params)
    hidden = names("h", len(first[0]))
    known = rows.where(total([F.col(c) for c in ["y", *inputs]]).isNotNull())
    state = known.select("*", *[relu(v).alias(c) for v, c in zip(linear(inputs, first, _bias(params, 0)), hidden)])
    ends = [f"z_{k}" for k in range(len(second))]
    sent = state.select(
        "blk", "t", "node_id", "y", *[linear(hidden, [[w] for w in tap])[0].alias(z) for tap, z in zip(second, ends)]
    )
    if isinstance(params, GcnParams):
        out = propagate(sent, op, ends, carry=["y"])
    else:
        out = chebyshev_sum(sent, op, [[z] for z in ends], ["z_0"], carry=["y"])
    level = F.col("z_0") + F.lit(float(_bias(params, 1)[0]))
    gap = relu(level) - F.col("y")
    errors = out.select(
        "blk", "t", "node_id", (gap * gap).alias("sq"), F.when(level > 0, gap * 2.0).otherwise(0.0).alias("d")
    )
    if isinstance(params, GcnParams):
        back = propagate(errors, op.transposed(), ["d"], carry=["d", "sq"], out=["v_0"])
    else:
        back = chebyshev_basis(errors, op, ["d"], params.order, carry=["sq", "d"])
        back = back.withColumnsRenamed({f"d_k{k}": f"v_{k}" for k in range(params.order + 1)})
    back_taps = [F.col(f"v_{k}") for k in range(len(second))]
    # Beyond the broadcast bound both sides lie by block: the narrow one is hashed there, and the wide one need not be sorted.
    joined = state.drop("y").join(back.hint("shuffle_hash") if op.dealt is not None else back, ["blk", "t", "node_id"])
    inner = [
        F.when(F.col(c) > 0, total([v * F.lit(float(tap[n])) for v, tap in zip(back_taps, second)])).otherwise(0.0)
        for n, c in enumerate(hidden)
    ]
    layer_errors = [f"e_{n}" for n in range(len(hidden))]
    ready = joined.select("*", *[e.alias(n) for e, n in zip(inner, layer_errors)])
    width = max(len(hidden), 3)

    def part(number: int, values: Sequence[Column]) -> Column:
        padded = [*values, *[F.lit(0.0)] * (width - len(values))]
        return F.struct(F.lit(number).alias("part"), *[v.alias(f"g_{n}") for n, v in enumerate(padded, 1)])

    parts = [[F.col(x) * F.col(e) for e in layer_errors] for x in inputs]
    parts.append([F.col(e) for e in layer_errors])
    parts += [[F.col(c) * v for c in hidden] for v in back_taps]
    parts.append([F.col("d"), F.col("sq"), F.lit(1.0)])
    unfolded = ready.select(F.explode(F.array(*[part(n, p) for n, p in enumerate(parts)])).alias("p")).select("p.*")
    return unfolded.groupBy("part").agg(*[F.sum(f"g_{n}").alias(f"g_{n}") for n in range(1, width + 1)])


def _gradient_in_block(series: Series, op: Operator, params: FilterParams, h: int) -> DataFrame:
    """`filter_gradient` with a dealt operator: the filters, both layers and the way back run in the block, and its sums leave it."""
    net, (begin, end) = SeriesNetwork(params, h, series.block), series.span
    first, second = _first_layer(params), _second_layer(params)
    width = max(len(first[0]), 3)

    def sum_of(*columns) -> float:
        known = columns[0][1].copy()
        for _, k in columns[1:]:
            known &= k
        product = columns[0][0][known]
        for x, _ in columns[1:]:
            product = product * x[known]
        return float(product.sum())

    def back_taps(edges, error, rows):
        if isinstance(params, GcnParams):
            taps, reached = edges.spread([error], rows, flipped=True)
            return taps, reached
        levels, reached = inblock.chebyshev(edges, [error], rows, params.order)
        return [level[0] for level in levels], reached

    def kernel(edges, steps, blk):
        total_of = np.zeros((len(first) + 2 + len(second), width))
        seen = False
        for t, rows, target, inputs, hidden in net.hidden(edges, steps, blk):
            if not begin <= t < end:
                continue
            rows = rows & target[1]
            for _, known in inputs:
                rows &= known
            if not rows.any():
                continue
            target, hidden = inblock.only(target, rows), [inblock.only(x, rows) for x in hidden]
            out, reached = net.output(edges, rows, hidden)
            level, known = out[0] + _bias(params, 1)[0], out[1]
            gap = np.maximum(level, 0.0) - target[0]
            both = known & target[1]
            high = known & (level > 0)
            squared = np.where(both, gap * gap, 0.0), both
            # without a target the error of a cut output is zero, that of another unknown
            error = np.where(high & both, 2.0 * gap, 0.0), reached & (both | ~high)
            taps, back = back_taps(edges, error, reached)
            kept = rows & back
            error, squared = inblock.only(error, kept), inblock.only(squared, kept)
            taps, hidden = [inblock.only(v, kept) for v in taps], [inblock.only(x, kept) for x in hidden]
            inner = []
            for n, (x, _) in enumerate(hidden):
                through = inblock.linear(taps, [[tap[n]] for tap in second])[0]
                active = x > 0
                inner.append((np.where(active, through[0], 0.0), kept & (through[1] | ~active)))
            number = 0
            for x in inputs:
                total_of[number, : len(inner)] += [sum_of(x, e) for e in inner]
                number += 1
            total_of[number, : len(inner)] += [sum_of(e) for e in inner]
            for v in taps:
                number += 1
                total_of[number, : len(hidden)] += [sum_of(x, v) for x in hidden]
            total_of[number + 1, :3] += [sum_of(error), sum_of(squared), float(kept.sum())]
            seen = True
        if seen:
            yield [np.arange(len(total_of)), *total_of.T]

    names_of = [f"g_{n}" for n in range(1, width + 1)]
    sums = inblock.in_blocks(series.df, op, ["y"], kernel, "part int, " + ", ".join(f"{n} double" for n in names_of))
    return sums.groupBy("part").agg(*[F.sum(n).alias(n) for n in names_of])


def gradient_of(sums: DataFrame, params: FilterParams, h: int) -> tuple[float, int, dict[str, np.ndarray]]:
    """Mean squared error, number of cells, and the gradient by tensor. The table has some dozen rows."""
    n_inputs, n_taps = len(input_names(params, h)), len(_second_layer(params))
    hid = len(_first_layer(params)[0])
    table = {r["part"]: [r[f"g_{n}"] for n in range(1, max(hid, 3) + 1)] for r in sums.collect()}
    out_error, squared, cells = table[n_inputs + 1 + n_taps][:3]
    gradient = {
        "w1": np.array([table[p][:hid] for p in range(n_inputs)]) / cells,
        "b1": np.array(table[n_inputs][:hid]) / cells,
        "w2": np.array([table[n_inputs + 1 + k][:hid] for k in range(n_taps)]) / cells,
        "b2": np.array([out_error]) / cells,
    }
    return squared / cells, int(cells), gradient


def flat_params(params: FilterParams) -> dict[str, np.ndarray]:
    return {
        "w1": np.array(_first_layer(params), dtype=float),
        "b1": np.array(_bias(params, 0), dtype=float),
        "w2": np.array(_second_layer(params), dtype=float),
        "b2": np.array(_bias(params, 1), dtype=float),
    }


def with_values(params: FilterParams, flat: dict[str, np.ndarray]) -> FilterParams:
    biases = [flat["b1"].tolist(), flat["b2"].tolist()]
    if isinstance(params, GcnParams):
        return GcnParams([flat["w1"].tolist(), flat["w2"][0][:, None].tolist()], biases)
    taps = params.order + 1
    per_tap = flat["w1"].reshape(taps, -1, flat["w1"].shape[1])
    return ChebParams([per_tap.tolist(), flat["w2"][:, :, None].tolist()], biases, params.normalize)


# --- updates -------------------------------------------------------------------------------------------------

@dataclass
class Adam:
    rate: float = LEARNING_RATE
    steps: int = 0
    mean: dict[str, np.ndarray] = field(default_factory=dict)
    square: dict[str, np.ndarray] = field(default_factory=dict)

    def update(self, values: dict[str, np.ndarray], gradient: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        self.steps += 1
        updated = {}
        for key, g in gradient.items():
            self.mean[key] = BETAS[0] * self.mean.get(key, 0.0) + (1 - BETAS[0]) * g
            self.square[key] = BETAS[1] * self.square.get(key, 0.0) + (1 - BETAS[1]) * g * g
            mean = self.mean[key] / (1 - BETAS[0] ** self.steps)
            square = self.square[key] / (1 - BETAS[1] ** self.steps)
            updated[key] = values[key] - self.rate * mean / (np.sqrt(square) + EPSILON)
        return updated


@dataclass
class Trained:
    params: FilterParams
    losses: list[float]


def batches(
    rows: DataFrame | Series, span: tuple[int, int], batch_steps: int | None, seed: int, epoch: int
) -> Iterator[DataFrame | Series]:
    """The rows of each shuffled batch of steps; with batch_steps=None all rows at once."""
    if batch_steps is None:
        yield rows
        return
    number = batch_shuffled(F.col("t"), span, seed, epoch, batch_steps)
    for b in range(-(-(span[1] - span[0]) // batch_steps)):
        yield rows.where(number == b)


def train(
    panel: DataFrame, graph: Graph, params: FilterParams, h: int, span: tuple[int, int], *, epochs: int = EPOCHS,
    batch_steps: int | None = BATCH_STEPS, rate: float = LEARNING_RATE, seed: int = 0, graph_type: str = "connect",
) -> Trained:
    """Minimise the squared error over the target steps in `span` of a scaled panel.

    `losses` has the loss of each epoch. A batch is a set of steps with all their nodes, and one Spark job; on large
    panels take many more than 64 steps per batch, or None for all.
    """
    if not isinstance(params, FilterParams):
        raise ValueError(f"no training for {type(params).__name__}")
    op = operator_for(params, graph, graph_type).settled()
    rows, op = settled_rows(panel, graph, op, params, h, span, whole=batch_steps is None)
    adam, losses = Adam(rate), []
    n_samples = span[1] - span[0]
    for epoch in range(epochs):
        summed = 0.0
        for batch in batches(rows, span, batch_steps, seed, epoch):
            loss, _, gradient = gradient_of(filter_gradient(batch, op, params, h), params, h)
            params = with_values(params, adam.update(flat_params(params), gradient))
            summed += loss
        losses.append(LOSS_SCALE * summed / n_samples)
    return Trained(params, losses)


# --- linear head ---------------------------------------------------------------------------------------------

def gram(rows: DataFrame, inputs: Sequence[str], target: str = "y") -> DataFrame:
    """Normal-equation sums: a row per input (and one for the constant) with its products with all inputs, the constant
    and the target."""
    known = rows.where(total([F.col(c) for c in [target, *inputs]]).isNotNull()).withColumn("one", F.lit(1.0))
    factors = [*inputs, "one"]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("row"), F.col(c).alias("x")) for n, c in enumerate(factors)]))
    unfolded = known.select(*factors, target, each.alias("f")).select("f.row", "f.x", *factors, target)
    sums = [F.sum(F.col("x") * F.col(c)).alias(f"c_{n}") for n, c in enumerate(factors)]
    return unfolded.groupBy("row").agg(*sums, F.sum(F.col("x") * F.col(target)).alias("c_y"))


PIVOT_FLOOR = 1e-12


def solved(sums: DataFrame, n_inputs: int) -> DataFrame:
    """Sweep the normal-equation sums of `gram` to a solution: row (place of the input, n_inputs for the intercept), value.

    The table has a row per input, so it is folded into one row of arrays and every pivot is swept there by array functions. An
    input whose pivot falls to 1e-12 of its own sum of squares depends on those before it; its coefficient is 0.
    """
    n = n_inputs + 1
    line = F.array(*[F.col(f"c_{k}") for k in range(n)], F.col("c_y"))
    one_row = sums.select(F.struct("row", line.alias("line")).alias("r")).agg(F.sort_array(F.collect_list("r")).alias("rows"))
    matrix = one_row.select(F.transform("rows", lambda r: r["line"]).alias("m")).where(F.size("m") == n)
    squares = F.transform(F.col("m"), lambda r, k: F.get(r, k))

    def sweep(m, k):
        pivot_row = F.get(m, k)
        pivot = F.get(pivot_row, k)
        usable = F.abs(pivot) > F.lit(PIVOT_FLOOR) * F.get(F.col("squares"), k)
        clear = lambda r: F.zip_with(r, pivot_row, lambda x, p: x - F.get(r, k) / pivot * p)
        scaled = F.transform(pivot_row, lambda x: x / pivot)
        swept = F.transform(m, lambda r, i: F.when(i == k, scaled).otherwise(clear(r)))
        # A dependent input leaves the system: its row and its column become zero.
        out = F.transform(m, lambda r, i: F.transform(r, lambda x, j: F.when((i == k) | (j == k), 0.0).otherwise(x)))
        return F.when(usable, swept).otherwise(out)

    done = matrix.withColumn("squares", squares).select(
        F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), F.col("m"), sweep).alias("m")
    )
    return done.select(F.posexplode(F.transform("m", lambda r: F.get(r, F.lit(n)))).alias("row", "value"))


def linear_fit(rows: DataFrame, inputs: Sequence[str], target: str = "y") -> tuple[list[float], float]:
    """Least squares of the target on the filtered history: coefficients and intercept. One aggregation over the rows."""
    values = [float(r.value) for r in solved(gram(rows, inputs, target), len(inputs)).orderBy("row").collect()]
    if not values:
        raise ValueError("no row with all inputs and the target")
    return values[:-1], values[-1]


def linear_start(coefficients: Sequence[float], intercept: float, hidden: int) -> GcnParams:
    """A convolution network whose first hidden column is the linear fit; a start point for `train`."""
    weight = [[float(c)] + [0.01 * (n + 1)] * (hidden - 1) for n, c in enumerate(coefficients)]
    return GcnParams(
        [weight, [[1.0]] + [[0.01]] * (hidden - 1)], [[float(intercept)] + [0.0] * (hidden - 1), [0.0]]
    )
