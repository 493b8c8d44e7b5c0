"""Edge files and node order files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowgraph.plans.sizing import cut
from flowgraph.schemas import EDGE_FILE_SCHEMA

HEADER = ",".join(EDGE_FILE_SCHEMA.fieldNames())


def _edge_lines(spark: SparkSession, path) -> DataFrame:
    """The lines below the header, their fields, and whether they are two ids and a cost.

    Lines are split here rather than by the CSV reader, whose mark for a bad row cannot be queried on its own.
    """
    lines = spark.read.text(path).select(F.regexp_replace("value", r'["\r]', "").alias("row"))
    body = lines.where((F.trim("row") != "") & (F.lower(F.replace("row", F.lit(" "), F.lit(""))) != HEADER))
    fields = body.select("row", F.split("row", ",").alias("f")).select(
        "row", "f", *[F.trim(F.get("f", F.lit(n))).alias(c) for n, c in enumerate(EDGE_FILE_SCHEMA.fieldNames())]
    )
    typed = fields.select("row", "f", *edge_casts())
    complete = (F.size("f") == 3) & F.col("src").isNotNull() & F.col("dst").isNotNull() & F.col("weight").isNotNull()
    return typed.select("row", "src", "dst", "weight", complete.alias("good"))


def read_edges(spark: SparkSession, path) -> DataFrame:
    """CSV with header from,to,cost -> src, dst, weight. Rows that are not two ids and a cost are left out."""
    return _edge_lines(spark, path).where("good").select("src", "dst", "weight")


def rejected_edges(spark: SparkSession, path) -> DataFrame:
    """The rows that `read_edges` leaves out: wrong field count or text that is no number."""
    return _edge_lines(spark, path).where("not good").select("row")


@dataclass(frozen=True)
class CheckedEdges:
    """The rows of edge files, written once: `good` (src, dst, weight) and `rejected` (file, row, reason)."""

    good: DataFrame
    rejected: DataFrame


def checked_edges(spark: SparkSession, path) -> CheckedEdges:
    """Read edge files with the CSV reader (quotes as CSV has them) and keep what it could not read.

    The reader's rows are written to the checkpoint folder once; good and rejected rows are selections of that table, so the files
    are parsed in one pass. Reasons: `malformed` (field count, text that is no number), `missing` (an empty id or cost), and
    `not_finite` (a cost that is NaN or infinite; its row is put together from the parsed fields).
    """
    corrupt = "_corrupt"
    schema = StructType([*EDGE_FILE_SCHEMA.fields, StructField(corrupt, StringType())])
    read = (
        spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", True)
        .option("columnNameOfCorruptRecord", corrupt).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    names = EDGE_FILE_SCHEMA.fieldNames()
    source, target, cost = (F.col(f"`{c}`") for c in names)
    rebuilt = F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in (source, target, cost)])
    reason = (
        F.when(F.col(corrupt).isNotNull(), "malformed")
        .when(source.isNull() | target.isNull() | cost.isNull(), "missing")
        .when(F.isnan(cost) | (F.abs(cost) == F.lit(float("inf"))), "not_finite")
    )
    kept = cut(
        read.select(
            source.cast("bigint").alias("src"), target.cast("bigint").alias("dst"), cost.cast("double").alias("weight"),
            F.col("_metadata.file_name").alias("file"), F.coalesce(corrupt, rebuilt).alias("row"), reason.alias("reason"),
        )
    )
    return CheckedEdges(
        kept.where("reason is null").select("src", "dst", "weight"),
        kept.where("reason is not null").select("file", "row", "reason"),
    )


def edge_casts(source: str = "from", target: str = "to", cost: str = "cost") -> list[Column]:
    return [
        F.expr(f"try_cast(`{source}` as bigint)").alias("src"),
        F.expr(f"try_cast(`{target}` as bigint)").alias("dst"),
        F.expr(f"try_cast(`{cost}` as double)").alias("weight"),
    ]


def edge_columns(raw: DataFrame, source: str = "from", target: str = "to", cost: str = "cost") -> DataFrame:
    """Cast and rename text columns to src, dst, weight; text that is no number becomes null."""
    return raw.select(*edge_casts(source, target, cost))


def read_node_order(spark: SparkSession, path) -> DataFrame:
    """One raw id per line -> (raw_id, idx), idx dense from 0 in line order; files in the order of their names.

    Lines are numbered inside each file split, and a table with one row per split gives the offsets.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"),
        F.trim("value").alias("value"),
    ).where(F.col("value") != "")
    inside = Window.partitionBy("_file", "_start").orderBy("_line")
    numbered = lines.withColumn("_row", F.row_number().over(inside) - 1)
    splits = lines.groupBy("_file", "_start").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_file", "_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    return numbered.join(offsets, ["_file", "_start"]).select(
        F.col("value").cast("bigint").alias("raw_id"), (F.col("_offset") + F.col("_row")).cast("bigint").alias("idx")
    )
