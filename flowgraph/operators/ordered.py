"""Previous-row lookup and running sums over a whole table, without one task ever holding the table.

The rows are cut into ranges, each range is handled by a window of bounded size, and a small table with one row
per range carries what crosses the borders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgraph.plans.sizing import cut


def with_previous(df: DataFrame, order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Add `prev_<c>` for each column in `carry`: its value in the row just before, in the order of `order`.

    The columns of `order` must identify a row. Range partitioning on them splits any hot value of the first column.
    The part numbers are written out before use, so that a lost executor cannot change them.
    """
    parts = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(*order)
    ends = parts.groupBy("_part").agg(F.max(F.struct(*order, *[F.col(c).alias(f"_end_{c}") for c in carry])).alias("_end"))
    # One row per range partition.
    border = ends.select("_part", F.lag("_end").over(Window.orderBy("_part")).alias("_before"))
    joined = parts.withColumn("_row", F.row_number().over(inside))
    for c in carry:
        joined = joined.withColumn(f"_lag_{c}", F.lag(c).over(inside))
    joined = joined.join(F.broadcast(border), "_part", "left")
    return joined.select(
        *df.columns,
        *[
            F.when(F.col("_row") == 1, F.col(f"_before._end_{c}")).otherwise(F.col(f"_lag_{c}")).alias(f"prev_{c}")
            for c in carry
        ],
    )


def running_sum(df: DataFrame, index: str, value: str, out: str, chunk: int = 4096) -> DataFrame:
    """Add the inclusive running sum of `value` in the order of the dense integer column `index`."""
    chunked = df.withColumn("_chunk", F.floor(F.col(index) / F.lit(chunk)))
    inside = Window.partitionBy("_chunk").orderBy(index).rowsBetween(Window.unboundedPreceding, 0)
    totals = chunked.groupBy("_chunk").agg(F.sum(value).alias("_total"))
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_chunk", F.coalesce(F.sum("_total").over(earlier), F.lit(0.0)).alias("_offset"))
    return (
        chunked.withColumn(out, F.sum(value).over(inside))
        .join(offsets, "_chunk")
        .withColumn(out, F.col(out) + F.col("_offset"))
        .drop("_chunk", "_offset")
    )
