"""What several operators share: written tables, bounded bit tables for filtering, the shape of a word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgraph.plans.sizing import shared_path

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet below the shared checkpoint folder and go on from there; the files outlive any executor."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_in(text: str = "text") -> Column:
    """Number of words; null counts as empty."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def apart(docs: DataFrame, *read: str) -> DataFrame:
    """docs with all columns but those in `read` under names that no operator uses; `toDF(*docs.columns)` gives the names back."""
    return docs.toDF(*[c if c in read else f"given_{n}" for n, c in enumerate(docs.columns)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bit_table(cells: DataFrame, cell: str) -> DataFrame:
    """The cells that occur in a column, as rows (bucket, bits) of 4 KB bitmaps.

    With cells in 0..n-1 the table has at most n / 32768 rows, 4 KB each, whatever the number of rows read: that bound
    lets it be broadcast.
    """
    at = F.col(cell).cast("long") + 1
    return cells.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )


def has_bit(rows: DataFrame, cell: str, bits: DataFrame, name: str) -> DataFrame:
    """Add the boolean column `name`: whether the row's cell is set in the bit table."""
    at = F.col(cell).cast("long") + 1
    keyed = bits.select(F.col("bucket").alias(f"_{name}_bucket"), F.col("bits").alias(f"_{name}_bits"))
    with_key = rows.withColumn(f"_{name}_key", F.bitmap_bucket_number(at))
    joined = with_key.join(F.broadcast(keyed), F.col(f"_{name}_key") == F.col(f"_{name}_bucket"), "left")
    byte = F.expr(
        f"cast(conv(hex(substring(_{name}_bits, cast(bitmap_bit_position(cast({cell} as bigint) + 1) div 8 as int) + 1, 1)), 16, 10) as int)"
    )
    bit = F.expr(f"cast(bitmap_bit_position(cast({cell} as bigint) + 1) % 8 as int)")
    found = F.coalesce(F.getbit(byte, bit) == 1, F.lit(False))
    return joined.withColumn(name, found).drop(f"_{name}_key", f"_{name}_bucket", f"_{name}_bits")
