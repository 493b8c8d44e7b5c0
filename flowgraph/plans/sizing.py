"""Sizes, broadcasts and lineage cuts.

A side of a join is broadcast only when a bound on its row count is known and small. Beyond the bound the
join shuffles, and the many-row side is spread over salts so that one hot key never lands in one task.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_SALTS = 32
# Steps per block where nodes are few, and partitions per block and wave of tasks where they are many.
STEP_BLOCK = 24
SPARE_PARTS = 2


def broadcast_rows(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.flowgraph.broadcastRows", str(DEFAULT_BROADCAST_ROWS)))


def salts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.flowgraph.salts", str(DEFAULT_SALTS)))


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only in local mode and only when unset."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", "")
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="flowgraph-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table below the checkpoint folder."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder and go on from the written rows; they outlive any executor."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def by_block(df: DataFrame, block: int | None = None) -> DataFrame:
    """Shuffle by block of steps. With a number of its own the shuffle is not coalesced, so a task rarely has two large blocks, and all
    sides of a join on blocks have the same number. Where blocks are cut shorter than STEP_BLOCK, they are more, and so are the partitions: a
    hash deals several blocks to some of them, and what a task holds in memory grows with their number."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts * (SPARE_PARTS * -(-STEP_BLOCK // block) if block and block < STEP_BLOCK else 1), "blk")


def keep_blocks_in_place(spark: SparkSession) -> None:
    """Let joins on (block, node) take sides that are both partitioned by block as they are; Spark's default shuffles them again."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


@dataclass(frozen=True)
class Settled:
    """A written table and its row count."""

    df: DataFrame
    rows: int


def settle(df: DataFrame) -> Settled:
    written = cut(df)
    return Settled(written, written.count())


def sized_join(
    many: DataFrame, few: DataFrame, on: str, rows: int, *, spread: str, how: str = "inner"
) -> DataFrame:
    """Join `many` with `few` on one column, where `few` has at most `rows` rows.

    Up to the broadcast bound no row of `many` moves. Beyond it `few` is repeated once per salt and the rows of
    `many` with the same key are divided over the salts by a hash of `spread`. `how` is inner, left or left_semi.
    """
    spark = many.sparkSession
    if rows <= broadcast_rows(spark):
        return many.join(F.broadcast(few), on, how)
    n = salts(spark)
    salted = many.withColumn("_salt", F.pmod(F.hash(spread), F.lit(n)))
    repeated = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return salted.join(repeated, [on, "_salt"], how).drop("_salt")
