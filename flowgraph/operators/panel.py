"""The node-by-step panel: dense grid, scaling, history windows, day splits, batches, profiles."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgraph.functions.scalars import min_max_restored, min_max_scaled, steps_per_day
from flowgraph.plans.sizing import STEP_BLOCK, by_block, settle, sized_join
from flowgraph.schemas import FEATURES

GRID_BLOCK = 24
NODE_BLOCK = 4096
BATCH_STEPS = 64


# --- grid and shape ------------------------------------------------------------------------------------------

def densify(readings: DataFrame, nodes: DataFrame, n_steps: int, value: str = "flow", fill: float | None = 0.0) -> DataFrame:
    """A row for every node and step 0..n_steps-1; several readings of a cell add up, empty cells get `fill`.

    The readings are summed into one row per node and block of steps before they move, and the grid is joined on
    those blocks, so only 1/24 of the final rows pass the shuffle.
    """
    slots = [f"_s{k}" for k in range(GRID_BLOCK)]
    inside = readings.where((F.col("t") >= 0) & (F.col("t") < n_steps))
    blocks = inside.groupBy("node_id", F.floor(F.col("t") / GRID_BLOCK).cast("bigint").alias("_block")).agg(
        *[F.sum(F.when(F.col("t") % GRID_BLOCK == k, F.col(value))).alias(s) for k, s in enumerate(slots)]
    )
    last = (n_steps - 1) // GRID_BLOCK
    grid = nodes.select("node_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))).alias("_block"))
    wide = grid.join(blocks, ["node_id", "_block"], "left")
    cells = [F.coalesce(F.col(s).cast("double"), F.lit(fill).cast("double")) for s in slots]
    long = wide.select("node_id", "_block", F.posexplode(F.array(*cells)).alias("_slot", value))
    step = F.col("_block") * GRID_BLOCK + F.col("_slot")
    return long.select("node_id", step.alias("t"), value).where(F.col("t") < n_steps)


def panel_shape(panel: DataFrame) -> DataFrame:
    """Counts and range of the panel; two-level, so no distinct set is built in one task."""
    per_node = panel.groupBy("node_id").agg(F.count("*").alias("n"))
    per_step = panel.groupBy("t").agg(F.lit(1).alias("one"))
    nodes = per_node.agg(F.count("*").alias("nodes"), F.sum("n").cast("bigint").alias("cells"))
    steps = per_step.agg(F.count("*").alias("steps"), F.min("t").alias("first_step"), F.max("t").alias("last_step"))
    # Two one-row tables.
    return nodes.withColumn("_k", F.lit(1)).join(steps.withColumn("_k", F.lit(1)), "_k").drop("_k")


def single_feature(panel: DataFrame, feature: str = FEATURES[0], out: str = "flow") -> DataFrame:
    return panel.select("node_id", "t", F.col(feature).alias(out))


def feature_profile(
    panel: DataFrame, features: Sequence[str] = FEATURES, bins: int = 10, percentiles: Sequence[float] = ()
) -> DataFrame:
    """Per feature: count, mean, stddev, min, max, coefficient of variation, optional approximate percentiles, and a
    histogram of equal bins between min and max."""
    long = panel.select(
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])).alias("e")
    ).select("e.feature", "e.x").where(F.col("x").isNotNull())
    stats = [
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("stddev"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
    ]
    if percentiles:
        stats.append(F.percentile_approx("x", list(percentiles), 10_000).alias("percentiles"))
    summary = long.groupBy("feature").agg(*stats)
    position = F.floor((F.col("x") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0)) * bins)
    # least() skips nulls, so a constant feature needs its bin first.
    bin_no = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1))
    # One summary row per feature name.
    binned = long.join(F.broadcast(summary.select("feature", "low", "high")), "feature")
    histogram = binned.groupBy("feature").agg(
        *[F.count_if(bin_no == b).alias(f"bin_{b}") for b in range(bins)]
    )
    variation = (F.col("stddev") / F.nullif("mean", F.lit(0.0))).alias("variation")
    return summary.join(F.broadcast(histogram), "feature").select(*summary.columns, variation, *[f"bin_{b}" for b in range(bins)])


# --- scaling -------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Base:
    """Per-node max_flow and min_flow, settled."""

    df: DataFrame
    rows: int


def base_table(panel: DataFrame, value: str = "flow", span: tuple[int, int] | None = None) -> DataFrame:
    """Per-node extremes over all steps, or over the half-open step range `span` (to fit on the train part only)."""
    if span is not None:
        panel = panel.where((F.col("t") >= span[0]) & (F.col("t") < span[1]))
    return panel.groupBy("node_id").agg(F.max(value).alias("max_flow"), F.min(value).alias("min_flow"))


def fit_base(panel: DataFrame, value: str = "flow", span: tuple[int, int] | None = None) -> Base:
    s = settle(base_table(panel, value, span))
    return Base(s.df, s.rows)


def _with_base(df: DataFrame, base: Base) -> DataFrame:
    return sized_join(df, base.df, "node_id", base.rows, spread="t")


def scale(panel: DataFrame, base: Base, columns: Sequence[str] = ("flow",), constant: str = "null") -> DataFrame:
    joined = _with_base(panel, base)
    high, low = F.col("max_flow"), F.col("min_flow")
    return joined.select(
        *[min_max_scaled(F.col(c), high, low, constant).alias(c) if c in columns else c for c in panel.columns]
    )


def unscale(df: DataFrame, base: Base, columns: Sequence[str]) -> DataFrame:
    joined = _with_base(df, base)
    high, low = F.col("max_flow"), F.col("min_flow")
    return joined.select(*[min_max_restored(F.col(c), high, low).alias(c) if c in columns else c for c in df.columns])


# --- history windows -----------------------------------------------------------------------------------------

def lag_names(h: int, prefix: str = "x") -> list[str]:
    return [f"{prefix}_{k}" for k in range(1, h + 1)]


def _home(block: int) -> Column:
    return F.floor(F.col("t") / block).cast("bigint")


def block_size(h: int, layout: str, block: int | None = None) -> int:
    if layout not in ("node", "step"):
        raise ValueError(f"layout must be node or step, not {layout!r}")
    return max(block or (NODE_BLOCK if layout == "node" else STEP_BLOCK), h)


def with_halo(panel: DataFrame, h: int, layout: str = "node", block: int | None = None) -> DataFrame:
    """Cut the steps into blocks `blk` and repeat the last h steps of a block in front of the next one.

    Whatever looks back at most h steps can then work inside (blk, node_id), a group of at most block + h rows however
    long a series is. layout="node" spreads the rows by (node, block). layout="step" keeps all nodes of a block of steps
    together, so that joins and sums over neighbours need no further shuffle; use it when the number of nodes is known
    and small.
    """
    size = block_size(h, layout, block)
    home = _home(size)
    near_end = F.pmod(F.col("t"), F.lit(size)) >= size - h
    copies = F.explode(F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))).alias("blk")
    rows = panel.select(copies, *panel.columns)
    return by_block(rows, size) if layout == "step" else rows.repartition("node_id", "blk")


def windows(
    rows: DataFrame,
    h: int,
    block: int,
    *,
    lags: dict[str, str] | None = None,
    mean: str | None = None,
    dense: bool = True,
    complete_only: bool = True,
) -> DataFrame:
    """History columns inside the blocks of `with_halo`; the repeated rows are dropped afterwards.

    `lags` maps a series column to a prefix: <prefix>_1..<prefix>_h are its values at t-h..t-1, oldest first. `mean`
    names a column whose mean over the same steps becomes hist_mean. All columns of the row itself are kept.
    """
    series = Window.partitionBy("blk", "node_id").orderBy("t")
    before = series.rowsBetween(-h, -1) if dense else series.rangeBetween(-h, -1)
    complete = F.lag("t", h).over(series).isNotNull() if dense else F.count("*").over(before) == h
    added = []
    for column, prefix in (lags or {}).items():
        for k, name in zip(range(h, 0, -1), lag_names(h, prefix)):
            at = F.lag(column, k).over(series) if dense else F.max(column).over(series.rangeBetween(-k, -k))
            added.append(at.alias(name))
    if mean:
        added.append(F.avg(mean).over(before).alias("hist_mean"))
    wide = rows.select("*", complete.alias("complete"), *added).where(_home(block) == F.col("blk"))
    return wide.where("complete").drop("complete") if complete_only else wide


def packed_series(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`with_halo` rows as one row per block and node: steps and an array per column in step order, at most block + h values each."""
    cells = rows.groupBy("blk", "node_id").agg(F.array_sort(F.collect_list(F.struct("t", *columns))).alias("cells"))
    return cells.select("blk", "node_id", F.col("cells.t").alias("steps"), *[F.col(f"cells.{c}").alias(c) for c in columns])


def packed_windows(blocks: DataFrame, h: int, block: int, keep: Sequence[str], lags: dict[str, str]) -> DataFrame:
    """`windows` of the dense series in `packed_series`, with the columns `keep`. Places of an array stand for rows in order, so
    nothing is sorted. The cells come out of `inline` as plain columns: places read in a projection would be copied by the optimizer into
    everything computed from them."""
    def cell(place: Column) -> Column:
        added = [F.get(c, place - k).alias(name) for c, prefix in lags.items() for k, name in zip(range(h, 0, -1), lag_names(h, prefix))]
        return F.struct(F.get("steps", place).alias("t"), *[F.get(c, place).alias(c) for c in keep], *added)

    places = F.when(F.size("steps") > h, F.sequence(F.lit(h), F.size("steps") - 1))
    # Series without a full history give one row of nulls, which the condition drops.
    return blocks.select("blk", "node_id", F.inline_outer(F.transform(places, cell))).where(_home(block) == F.col("blk"))


def history(
    panel: DataFrame,
    h: int,
    *,
    value: str = "flow",
    lags: bool = True,
    mean: bool = False,
    layout: str = "node",
    block: int | None = None,
    dense: bool = True,
    complete_only: bool = True,
) -> DataFrame:
    """For every target step t: x_1..x_h = the values at t-h..t-1 (oldest first) and/or hist_mean, and y = the value at t.

    dense=False is for panels with gaps: a missing step is null in its lag and left out of the mean. Rows without a full
    history are dropped unless complete_only=False, which adds the flag `complete` instead. With layout="step" the key
    `blk` stays in place.
    """
    rows = with_halo(panel.select("t", "node_id", F.col(value).alias("y")), h, layout, block)
    wide = windows(
        rows,
        h,
        block_size(h, layout, block),
        lags={"y": "x"} if lags else None,
        mean="y" if mean else None,
        dense=dense,
        complete_only=complete_only,
    )
    return wide if layout == "step" else wide.drop("blk")


def incomplete_windows(panel: DataFrame, h: int) -> DataFrame:
    """How many target rows have no full history."""
    flagged = history(panel, h, lags=False, complete_only=False)
    return flagged.agg(F.count_if(~F.col("complete")).alias("dropped"), F.count_if("complete").alias("kept"))


# --- splits --------------------------------------------------------------------------------------------------

def split_span(
    mode: str,
    divide_days: Sequence[int],
    time_interval: int,
    h: int,
    *,
    variant: str = "days",
    n_steps: int | None = None,
) -> tuple[int, int]:
    """Half-open range of target steps of the train or test part.

    variant="days": train [h, train days), test the test days after them. variant="clamped" starts the test h steps
    later and keeps it inside a panel of n_steps steps.
    """
    if mode not in ("train", "test"):
        raise ValueError(f"mode must be train or test, not {mode!r}")
    if variant not in ("days", "clamped"):
        raise ValueError(f"variant must be days or clamped, not {variant!r}")
    day = steps_per_day(time_interval)
    border = divide_days[0] * day
    wanted = divide_days[1] * day
    if variant == "days":
        return (h, border) if mode == "train" else (border, border + wanted)
    if n_steps is None:
        raise ValueError("the clamped split needs n_steps")
    if mode == "train":
        return h, min(border, n_steps)
    start = border + h
    return start, start + max(0, min(wanted, n_steps - h - 1 - border))


def within(df: DataFrame, span: tuple[int, int], before: int = 0) -> DataFrame:
    return df.where((F.col("t") >= span[0] - before) & (F.col("t") < span[1]))


def samples(panel: DataFrame, h: int, span: tuple[int, int], **options) -> DataFrame:
    """History windows of the target steps in `span`; the panel is cut to the steps they need before the window."""
    return within(history(within(panel, span, h), h, **options), span)


def split_label(t: Column, train: tuple[int, int], test: tuple[int, int]) -> Column:
    return F.when((t >= train[0]) & (t < train[1]), "train").when((t >= test[0]) & (t < test[1]), "test")


# --- batches -------------------------------------------------------------------------------------------------

def batch_in_order(t: Column, start: int, batch_steps: int = BATCH_STEPS) -> Column:
    return F.floor((t - F.lit(start)) / F.lit(batch_steps)).cast("bigint")


def shuffle_constants(n: int, seed: int, epoch: int) -> tuple[int, int]:
    """Factor and shift of a permutation p(k) = (factor * k + shift) mod n."""
    rng = random.Random(f"{seed}/{epoch}")
    factor = rng.randrange(1, max(n, 2))
    while math.gcd(factor, n) != 1:
        factor = rng.randrange(1, n)
    return factor, rng.randrange(max(n, 1))


def batch_shuffled(t: Column, span: tuple[int, int], seed: int, epoch: int, batch_steps: int = BATCH_STEPS) -> Column:
    """Batch number after a seeded permutation of the steps in `span`: all nodes of a step share a batch, every batch
    but the last has exactly batch_steps steps, and nothing is sorted or joined."""
    n = span[1] - span[0]
    factor, shift = shuffle_constants(n, seed, epoch)
    place = F.pmod((t - F.lit(span[0])) * F.lit(factor).cast("bigint") + F.lit(shift).cast("bigint"), F.lit(n))
    return F.floor(place / F.lit(batch_steps)).cast("bigint")


# --- series as arrays, slices --------------------------------------------------------------------------------

def to_series_arrays(df: DataFrame, columns: Sequence[str], block: int) -> DataFrame:
    """One array per node and block of steps, in step order. The block bounds the length of an array."""
    cell = F.struct("t", *columns)
    grouped = df.groupBy("node_id", F.floor(F.col("t") / block).cast("bigint").alias("block")).agg(
        F.array_sort(F.collect_list(cell)).alias("cells")
    )
    return grouped.select(
        "node_id", "block", F.col("cells.t").alias("steps"), *[F.col(f"cells.{c}").alias(c) for c in columns]
    )


def from_series_arrays(arrays: DataFrame, columns: Sequence[str]) -> DataFrame:
    zipped = arrays.select("node_id", F.explode(F.arrays_zip("steps", *columns)).alias("cell"))
    return zipped.select("node_id", F.col("cell.steps").alias("t"), *[F.col(f"cell.{c}").alias(c) for c in columns])


def slice_node(df: DataFrame, node_id: int, span: tuple[int, int], columns: Sequence[str]) -> DataFrame:
    """One node's rows in a step range, steps counted from the start of the range."""
    inside = (F.col("node_id") == node_id) & (F.col("t") >= span[0]) & (F.col("t") < span[1])
    return df.where(inside).select((F.col("t") - span[0]).alias("step"), *columns)


def first_samples(df: DataFrame, k: int) -> DataFrame:
    """All nodes of the k earliest steps."""
    earliest = df.select("t").distinct().orderBy("t").limit(k)
    # At most k rows.
    return df.join(F.broadcast(earliest), "t", "left_semi")
