"""Sparse matrix times feature table, for all time steps in one plan.

A feature table has `node_id`, feature columns and optionally the step keys `blk` and `t`. When the table is already
partitioned by `blk` and the operator is broadcast, neither the join nor the sum moves a row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgraph.operators import inblock
from flowgraph.operators.graph import Operator, directed_normalised, plain_edges
from flowgraph.plans.sizing import broadcast_rows, by_block, cut, keep_blocks_in_place, sized_join
from flowgraph.schemas import Graph

STEP_KEYS = ("blk", "t")
# Steps per travelling row, and aggregates per row that the JVM still compiles well (measured: 16 to 32).
MOST_STEPS = 48
MOST_SLOTS = 24
CUT_EVERY = 3
DEFAULT_HEAVY_EDGES = 10_000


def step_keys(features: DataFrame) -> list[str]:
    return [k for k in STEP_KEYS if k in features.columns]


def messages(features: DataFrame, op: Operator, way: str = "auto", heavy: int | None = None) -> DataFrame:
    """One row per matrix entry and feature row: receiver `i`, the sender's columns under `node_id`, weight `w`.

    way="broadcast": the smaller side of known size goes to all tasks. way="split": both sides are shuffled by sender, and the
    entries of senders with more than `heavy` of them are dealt apart (`split_messages`). "auto" broadcasts while the size is within the bound;
    beyond it, it takes the entries of the features' own block from an operator that is `dealt`.
    """
    if way not in ("auto", "broadcast", "split"):
        raise ValueError(f"way must be auto, broadcast or split, not {way!r}")
    matrix = op.df.select("i", F.col("j").alias("node_id"), "w")
    rows = op.rows if "_pack" in features.columns else op.nodes
    if way == "auto" and op.dealt is not None and "blk" in features.columns:
        return op.by_block().withColumnRenamed("j", "node_id").join(features.hint("shuffle_hash"), ["blk", "node_id"])
    if way == "split" or (way == "auto" and rows > broadcast_rows(features.sparkSession)):
        return split_messages(features, matrix, op.rows, heavy or heavy_edges(features.sparkSession))
    if "_pack" in features.columns:
        return features.join(F.broadcast(matrix), "node_id")
    return matrix.join(F.broadcast(features), "node_id")


def dealt(op: Operator, rows: DataFrame, block: int | None = None, always: bool = False) -> Operator:
    """`op` for rows in the step layout (`with_halo`): beyond the broadcast bound its entries are repeated once per block of steps and
    shuffled by block, as the rows are. The join and the sum over neighbours then stay inside a block: per step block the entries
    move, once for all passes of a plan, instead of a feature row along every entry. `block` is the block size of the rows. `always`: at any size."""
    if "blk" not in rows.columns or (op.rows <= broadcast_rows(rows.sparkSession) and not always):
        return op
    spark = rows.sparkSession
    keep_blocks_in_place(spark)
    entries = op.df.groupBy("i").agg(F.collect_list(F.struct("j", "w")).alias("_e"))
    # As two arrays an entry takes half the bytes it has as a row in one array.
    packed = cut(entries.select("i", F.col("_e.j").alias("js"), F.col("_e.w").alias("ws")))
    if packed.where("i is null").isEmpty():
        # Spark infers this filter for all passes of a plan but the last; with it in all of them, one shuffle serves them all.
        packed = packed.where("i is not null")
    # One row per block.
    blocks = cut(rows.select("blk").distinct())
    placed = by_block(packed.join(F.broadcast(blocks)).select("blk", "i", "js", "ws"), block)
    return replace(op, dealt=placed, flipped=False)


def met_in_block(features: DataFrame, op: Operator) -> bool:
    """Whether networks run inside the blocks of the features (`inblock`)."""
    return op.dealt is not None and not op.flipped and step_keys(features) == list(STEP_KEYS)


def heavy_edges(spark: SparkSession) -> int:
    """Most entries of one sender that may meet in one task."""
    return int(spark.conf.get("spark.flowgraph.heavyEdges", str(DEFAULT_HEAVY_EDGES)))


def heavy_senders(matrix: DataFrame, most: int) -> DataFrame:
    """node_id, slices: the senders with more than `most` entries, and into how many slices of about `most` these are dealt."""
    counted = matrix.groupBy("node_id").agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    return counted.select("node_id", F.ceil(F.col("_n") / most).cast("int").alias("_slices"))


def split_messages(features: DataFrame, matrix: DataFrame, rows: int, most: int) -> DataFrame:
    """`messages` by a shuffle on the sender, in which no sender has more than about `most` entries in one task.

    A histogram of the senders' entries marks the heavy ones (at most rows / most of them). Their entries are dealt over
    slices by a hash of the receiver, and only their feature rows are repeated, once per slice; all others meet in slice 0.
    The sums over a receiver are partial in each task and merge in the shuffle of the aggregation.
    """
    heavy = cut(heavy_senders(matrix, most))
    bound = rows // most
    dealt = sized_join(matrix, heavy, "node_id", bound, spread="i", how="left")
    slice_of = F.when(F.col("_slices").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("i"), F.col("_slices")).cast("int"))
    sliced = dealt.withColumn("_slice", slice_of).drop("_slices")
    marked = sized_join(features, heavy, "node_id", bound, spread="_pack" if "_pack" in features.columns else "node_id", how="left")
    repeated = marked.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1))).drop("_slices")
    return sliced.hint("merge").join(repeated, ["node_id", "_slice"]).drop("_slice")


def _slot(column: str, k: int) -> str:
    return f"{column}__{k}"


def _packed(features: DataFrame, keys: Sequence[str], columns: Sequence[str], steps: int) -> DataFrame:
    """One row per node and run of `steps` steps, a column per step, and the bits of the steps that have a row."""
    place = F.pmod(F.col("t"), F.lit(steps))
    slots = [
        F.max(F.when(place == k, F.col(c))).alias(_slot(c, k)) for c in columns for k in range(steps)
    ]
    present = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))).alias("_steps")
    run = F.floor(F.col("t") / steps).cast("bigint").alias("_pack")
    return features.groupBy(*keys, run, "node_id").agg(*slots, present)


def _unpacked(wide: DataFrame, keys: Sequence[str], columns: Sequence[str], steps: int) -> DataFrame:
    cells = [
        F.when(
            F.getbit("_steps", F.lit(k)) == 1,
            F.struct(
                (F.col("_pack") * steps + k).alias("t"), *[F.col(_slot(c, k)).alias(c) for c in columns]
            ),
        )
        for k in range(steps)
    ]
    rows = wide.select(*keys, "node_id", F.explode(F.array(*cells)).alias("_cell")).where("_cell is not null")
    return rows.select(*keys, "_cell.t", "node_id", *[F.col(f"_cell.{c}").alias(c) for c in columns])


def propagate(
    features: DataFrame,
    op: Operator,
    columns: Sequence[str],
    *,
    carry: Sequence[str] = (),
    out: Sequence[str] | None = None,
    combine: Callable[[Column], Column] = F.sum,
    factor: float = 1.0,
    plus: Sequence[str] = (),
    way: str = "auto",
    heavy: int | None = None,
) -> DataFrame:
    """y[i] = combine over j of w[i, j] * x[j], per step.

    `carry` columns are taken from the row of i itself and need an anchored operator. With an anchored operator a
    node without neighbours is kept, with null; otherwise it is absent. With `plus`, y[i] = factor * sum + plus[i],
    folded into the same sum; this needs an operator with exactly one (i, i) row per node.

    A run of steps of a node travels along an edge as one row with a column per step, so the edge join and the sum
    handle one row where they would handle dozens.
    """
    if (carry or plus) and not op.anchored:
        raise ValueError("carry and plus need an anchored operator")
    out = list(out or columns)
    keys = step_keys(features)
    if "t" not in keys:
        return _spread(features, op, keys, list(columns), out, list(carry), list(plus), combine, factor, way, heavy)
    keys.remove("t")
    read = list(dict.fromkeys([*columns, *carry, *plus]))
    steps = max(1, min(MOST_STEPS, MOST_SLOTS // (len(out) + len(carry))))

    def wide(some: Sequence[str]) -> list[str]:
        return [_slot(c, k) for c in some for k in range(steps)]

    sums = _spread(
        _packed(features, keys, read, steps), op, [*keys, "_pack"], wide(columns), wide(out), wide(carry), wide(plus),
        combine, factor, way, heavy,
    )
    return _unpacked(sums, keys, [*out, *carry], steps).select(*keys, "t", "node_id", *out, *carry)


def _spread(
    features: DataFrame, op: Operator, keys: Sequence[str], columns: Sequence[str], out: Sequence[str],
    carry: Sequence[str], plus: Sequence[str], combine: Callable[[Column], Column], factor: float, way: str,
    heavy: int | None,
) -> DataFrame:
    sent = messages(features, op, way, heavy)
    own = F.col("i") == F.col("node_id")
    terms = [F.col("w") * F.col(c) for c in columns]
    if plus:
        terms = [F.lit(factor) * x + F.when(own, F.col(p)).otherwise(0.0) for x, p in zip(terms, plus, strict=True)]
    results = [combine(x).alias(o) for x, o in zip(terms, out, strict=True)]
    results += [F.max(F.when(own, F.col(c))).alias(c) for c in carry]
    if "_steps" in features.columns:
        results.append(F.bit_or("_steps").alias("_steps"))
    gathered = sent.groupBy(*keys, "i").agg(*results)
    return gathered.withColumnRenamed("i", "node_id")


def directed_convolution(
    features: DataFrame, graph: Graph, columns: Sequence[str], mode: str = "total", block: int | None = None
) -> DataFrame:
    """Degree-normalised sum over incoming edges; only nodes with an incoming edge have a row."""
    return propagate(features, dealt(directed_normalised(graph, mode), features, block), columns)


def send_messages(
    graph: Graph, features: DataFrame, column: str, out: str = "message", combine: Callable[[Column], Column] = F.sum
) -> DataFrame:
    """Combine the senders' values at the receiver of every directed edge."""
    return propagate(features, plain_edges(graph), [column], out=[out], combine=combine)


def additive_rounds(
    graph: Graph, features: DataFrame, column: str, rounds: int = 3, null_mode: str = "propagate"
) -> DataFrame:
    """x <- x + sum of the senders' x, `rounds` times. A node that receives nothing becomes null, or keeps its value
    with null_mode="zero"."""
    if null_mode not in ("propagate", "zero"):
        raise ValueError(f"null_mode must be propagate or zero, not {null_mode!r}")
    op = plain_edges(graph).anchor(graph)
    keys = step_keys(features)
    extra = [c for c in features.columns if c not in (*keys, "node_id", column)]
    current = features
    for done in range(1, rounds + 1):
        received = propagate(current, op, [column], carry=[column, *extra], out=["_received"])
        gain = F.col("_received") if null_mode == "propagate" else F.coalesce("_received", F.lit(0.0))
        current = received.select(*keys, "node_id", (F.col(column) + gain).alias(column), *extra)
        if done % CUT_EVERY == 0 and done < rounds:
            current = cut(current)
    return current


def tap_names(columns: Sequence[str], order: int) -> list[list[str]]:
    return [[f"{c}_k{k}" for c in columns] for k in range(order + 1)]


def chebyshev_basis(
    features: DataFrame, op: Operator, columns: Sequence[str], order: int, carry: Sequence[str] = ()
) -> DataFrame:
    """Columns `<c>_k<k>` = T_k(op) x for k = 0..order, by the recurrence on the features; `carry` is kept. With a dealt operator all
    orders are made in the block (`inblock`)."""
    names = tap_names(columns, order)
    keys = step_keys(features)
    if met_in_block(features, op) and order:
        if carry and not op.anchored:
            raise ValueError("carry needs an anchored operator")

        def kernel(edges, steps, blk):
            for t, rows, cells in steps:
                levels, reached = inblock.chebyshev(edges, cells[: len(columns)], rows, order)
                yield t, reached, [*[inblock.only(x, reached) for x in cells[len(columns) :]], *[x for level in levels for x in level]]

        made = [*carry, *[n for level in names for n in level]]
        return inblock.in_blocks(features, op, [*columns, *carry], kernel, inblock.plain_schema(made))
    frame = features.select(
        *keys, "node_id", *carry, *[F.col(c).alias(n) for c, n in zip(columns, names[0])]
    )
    known = list(carry) + names[0]
    for k in range(1, order + 1):
        frame = propagate(frame, op, names[k - 1], carry=known, out=names[k])
        if k > 1:
            frame = frame.select(
                *keys,
                "node_id",
                *known,
                *[
                    (F.lit(2.0) * F.col(names[k][c]) - F.col(names[k - 2][c])).alias(names[k][c])
                    for c in range(len(columns))
                ],
            )
        known = known + names[k]
    return frame


def chebyshev_sum(
    features: DataFrame, op: Operator, taps: Sequence[Sequence[str]], out: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """sum over k of T_k(op) z_k, where taps[k] names the columns of z_k, by Clenshaw's backward recurrence.

    B_k = z_k + 2 op B_{k+1} - B_{k+2}, result = z_0 + op B_1 - B_2: one pass over the edges per order, and only the
    output columns travel. The operator needs exactly one (i, i) row per node.
    """
    keys = step_keys(features)
    order = len(taps) - 1
    current = [f"_b_{c}" for c in range(len(out))]
    own = [f"_z_{c}" for c in range(len(out))]
    after: list[str] = []
    frame = features.select("*", *[F.col(c).alias(b) for c, b in zip(taps[order], current)])
    for k in range(order - 1, -1, -1):
        left = [c for level in taps[:k] for c in level]
        rest = [F.col(z) - F.col(a) for z, a in zip(taps[k], after)] if after else [F.col(z) for z in taps[k]]
        frame = frame.select(*keys, "node_id", *carry, *left, *current, *[r.alias(o) for r, o in zip(rest, own)])
        after = [f"_a{k}_{c}" for c in range(len(out))] if k else []
        frame = frame.select("*", *[F.col(c).alias(a) for c, a in zip(current, after)])
        frame = propagate(
            frame, op, current, carry=[*carry, *left, *after], factor=2.0 if k else 1.0, plus=own
        )
    return frame.select(*keys, "node_id", *carry, *[F.col(c).alias(o) for c, o in zip(current, out)])
