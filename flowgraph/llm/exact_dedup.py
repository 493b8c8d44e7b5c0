"""Exact dedup with two passes over a Bloom filter; DataFrame functions only.

Texts are equal when they are identical after deleting every character of [\\x20\\x09-\\x0D]. Pass one counts how many rows
fall on each of `cells` cells, for two hashes of the normalised text, and keeps the cells hit more than once as two bitmaps of
cells / 8 bytes each (2 MB with the default; the bound does not depend on the number of rows, so they are broadcast). Pass
two looks up both cells of each row: a row with a cell hit only once has no equal and passes straight through; the others,
possibly repeated, are grouped by the SHA-256 of the normalised text. With far more rows than cells more of them are shuffled,
with the same result. Texts are read once and never shuffled; only ids, lengths and digests are.

Defined cases: a null text counts as empty; a null id sorts before all others; rows that repeat id and text share one
decision (group_size counts them all); an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgraph.llm.common import SPACES, bit_table, has_bit, stored

CELLS = 1 << 24
SALTS = 16


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, code points of the original text, SHA-256 of the normalised text."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(body).alias("points"),
        F.sha2(F.translate(body, SPACES, "").cast("binary"), 256).alias("text_sha256"),
    )


def possibly_repeated(rows: DataFrame, key: str, cells: int = CELLS) -> DataFrame:
    """Add `repeated`: false only for rows whose key occurs once."""
    first, second = F.pmod(F.xxhash64(key), F.lit(cells)), F.pmod(F.xxhash64(key, F.lit("second")), F.lit(cells))
    celled = rows.withColumn("_one", first).withColumn("_two", second)
    hits = (
        celled.select(F.explode(F.array(F.struct(F.lit(1).alias("k"), F.col("_one").alias("cell")),
                                        F.struct(F.lit(2).alias("k"), F.col("_two").alias("cell")))).alias("hit"))
        .groupBy("hit.k", "hit.cell").count().where("count > 1")
    )
    for k, cell in ((1, "_one"), (2, "_two")):
        celled = has_bit(celled, cell, bit_table(hits.where(F.col("k") == k), "cell"), f"_hit{k}")
    return celled.withColumn("repeated", F.col("_hit1") & F.col("_hit2")).drop("_one", "_two", "_hit1", "_hit2")


def exact_dedup(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs.

    Of equal texts the row with the most code points stays, then the smallest doc_id.
    """
    rows = possibly_repeated(stored(digests(docs), "digests"), "text_sha256", cells)
    single = rows.where(~F.col("repeated")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    maybe = rows.where("repeated").drop("repeated")
    best = maybe.groupBy("text_sha256").agg(
        F.min(F.struct((-F.col("points")).alias("order"), F.col("doc_id").alias("id"))).alias("best"), F.count("*").alias("group_size")
    )
    # Rows of a text that fills a third of the table are spread over salts; its one group row is repeated for each.
    salted = maybe.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    groups = best.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    joined = salted.join(groups, ["text_sha256", "salt"]).select(
        "doc_id",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("points") == -F.col("best.order"))).alias("kept"),
        "text_sha256",
    )
    return single.unionByName(joined)


ORACLE = r"""
with d as (select doc_id, length(coalesce(text, '')) as points,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents),
r as (select *, count(*) over (partition by text_sha256) as group_size,
             first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id) as keep_id from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from r
"""
