"""Packing into length buckets whose boundaries minimise padding.

A document is a sequence of words (runs of [^\\x20\\x09-\\x0D]); one longer than `max_words` is cut into pieces of max_words,
so no word is lost. The histogram of piece lengths, at most max_words rows however many documents there are, goes to the
driver, and dynamic programming over it picks the `buckets` upper boundaries with the least padding in all. Inside a bucket
with boundary b, pieces are numbered and every budget // b of them make a batch of at most `budget` words with padding.

Numbering sorts no bucket whole: pieces are dealt by a hash of the id into shards of some thousand, numbered there, and
start from the number of pieces in the shards before; only a bucket's last batch can be short.

Defined cases: a null text counts as empty; a document without words has one row with length 0 and no bucket, batch or
slot; repeated rows are packed one by one; the order of rows with equal hash, id and piece is open (they differ in further
columns at most); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgraph.llm.common import WORD, stored, words_in

MAX_WORDS = 2048
BUCKETS = 16
BUDGET = 16384
SHARD_ROWS = 2000


def boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper boundaries, ascending, of at most `buckets` buckets with the least sum of (boundary - length)."""
    lengths = np.array(sorted(x for x, n in histogram.items() if x > 0 and n > 0), np.int64)
    if len(lengths) == 0:
        return []
    counts = np.array([histogram[int(x)] for x in lengths], np.int64)
    pieces = np.concatenate([[0], np.cumsum(counts)])
    words = np.concatenate([[0], np.cumsum(counts * lengths)])
    n = len(lengths)
    best = np.full(n + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    last = []
    for _ in range(min(buckets, n)):
        cost, came = best.copy(), np.full(n + 1, -1)
        for j in range(1, n + 1):
            # one more bucket holds the lengths i..j-1
            total = best[:j] + lengths[j - 1] * (pieces[j] - pieces[:j]) - (words[j] - words[:j])
            i = int(np.argmin(total))
            if total[i] < cost[j]:
                cost[j], came[j] = total[i], i
        last.append(came)
        best = cost
    out, j = [], n
    for came in reversed(last):
        if j and came[j] >= 0:
            out.append(int(lengths[j - 1]))
            j = int(came[j])
    return sorted(out)


def _pieces(lengths: DataFrame, max_words: int) -> DataFrame:
    """A row per piece: piece, start_word, length."""
    n = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("_words") / max_words).cast("long"))
    return (
        lengths.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
        .withColumn("start_word", F.col("piece") * max_words)
        .withColumn("length", F.least(F.lit(max_words).cast("long"), F.col("_words") - F.col("start_word")))
    )


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, max_words: int = MAX_WORDS, with_text: bool = False) -> DataFrame:
    """doc_id, piece, start_word, length, bucket, padded, batch, slot, and with `with_text` the words of the piece as text."""
    if budget < max_words:
        raise ValueError("a batch must hold a piece of the greatest length")
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_in().alias("_words"))
    lengths = stored(sized, "lengths")
    pieces = _pieces(lengths, max_words)
    counts = stored(pieces.groupBy("length").count(), "histogram")
    histogram = {r["length"]: r["count"] for r in counts.collect()}  # at most max_words + 1 rows
    bounds = boundaries(histogram, buckets)
    shards = max(1, -(-sum(histogram.values()) // SHARD_ROWS))

    def placed(rows: DataFrame) -> DataFrame:
        bucket = F.coalesce(*[F.when((F.col("length") > 0) & (F.col("length") <= b), F.lit(k)) for k, b in enumerate(bounds)], F.lit(None).cast("int"))
        padded = F.element_at(F.array(*[F.lit(b).cast("long") for b in bounds]), bucket + 1) if bounds else F.lit(None).cast("long")
        return rows.withColumn("bucket", bucket).withColumn("padded", padded).withColumn(
            "shard", F.pmod(F.xxhash64("doc_id", "piece", F.lit("shard")), F.lit(shards))
        )

    per_shard = placed(pieces).where("bucket is not null").groupBy("bucket", "shard").count()
    earlier = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_shard.select("bucket", "shard", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("start"))
    if with_text:
        body = F.coalesce(F.col("text"), F.lit(""))
        rows = _pieces(docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_in().alias("_words"), body.alias("_text")), max_words)
        cut = F.array_join(F.slice(F.regexp_extract_all("_text", F.lit(f"({WORD})"), F.lit(1)), (F.col("start_word") + 1).cast("int"), F.lit(max_words)), " ")
        rows = rows.withColumn("text", F.when(F.col("_words") <= max_words, F.col("_text")).otherwise(cut)).drop("_text")
    else:
        rows = pieces
    rows = placed(rows)
    order = Window.partitionBy("bucket", "shard").orderBy(F.xxhash64("doc_id", "piece"), "doc_id", "piece")
    numbered = rows.where("bucket is not null").withColumn("n", F.row_number().over(order)).join(starts, ["bucket", "shard"])
    at, room = F.col("start") + F.col("n") - 1, F.floor(F.lit(budget) / F.col("padded"))
    columns = ["doc_id", "piece", "start_word", "length", "bucket", "padded"]
    text = ["text"] if with_text else []
    full = numbered.select(*columns, F.floor(at / room).cast("long").alias("batch"), (at % room).cast("long").alias("slot"), *text)
    bare = rows.where("bucket is null").select(*columns, F.lit(None).cast("long").alias("batch"), F.lit(None).cast("long").alias("slot"), *text)
    return full.unionByName(bare)
