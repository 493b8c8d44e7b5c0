"""Quality by importance resampling: how much likelier a target model makes a text than a model of the raw text.

Both models are bags of hashed n-grams. Target: the texts labelled good, from a bounded sample of labelled rows (`sample` rows
in the order of a hash of the id; its ids and labels, 16 bytes a row, are broadcast). Raw: all texts, every n-gram counted.
Features of a text are its word unigrams and bigrams, hashed to CELLS cells, and the unigrams, bigrams and trigrams of word
shapes (kind of first, middle and last character, and whether the word repeats the one before), hashed to SHAPES cells; the
shapes carry what word hashes can't: shouting, symbols after each word, repeated words. The log weight of a text is
the sum of log(target / raw) over its n-grams; with counts smoothed by `alpha`.

Resampling without replacement: key = log weight + Gumbel noise (from a hash of seed and id), and the k largest keys stay. k is
the number of texts whose log weight reaches the mark that `keep` of the labelled good texts reach, when each of them is scored
by a target model without its own n-grams: so the mark is one for texts the model has not seen, also where labels are few. The k-th largest key is found
by narrowing a histogram of keys, so nothing is sorted whole or collected.

Defined cases: a null or empty text has no n-grams and log weight 0; equal keys at the cut all stay; rows that repeat id and
text share their fate; a null id draws noise like the text 'null'; without labelled good texts every row stays; an empty table
gives no rows; further columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgraph.llm import words
from flowgraph.llm.common import apart, stored

CELLS = 1 << 16
SHAPES = 1 << 14
SAMPLE = 20_000
ALPHA = 0.5
KEEP = 0.9995
BINS = 1000

# Kinds of characters: 0 other, 1 lower case, 2 upper case, 3 digit, 4 sentence mark, 5 exclamation, 6 other symbol, 7 beyond ASCII
_KIND = np.zeros(256, np.uint64)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 7
for _c in b".,;:'\"()-":
    _KIND[_c] = 4
for _c in b"!?":
    _KIND[_c] = 5
for _c in b"#$%&*+/<=>@[\\]^_`{|}~":
    _KIND[_c] = 6
_ONE = np.uint64(1)


def _features(data: np.ndarray, offsets: np.ndarray):
    """Cells of all n-grams of the texts, and for each text how many come before it."""
    starts, ends, counts = words.word_spans(data, offsets)
    h = words.run_hashes(words._LOWER[data], starts, ends)
    first, last, middle = _KIND[data[starts]], _KIND[data[ends - 1]], _KIND[data[(starts + ends) // 2]]
    owner = np.repeat(np.arange(len(counts) - 1), np.diff(counts))
    same = np.zeros(len(h), np.uint64)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    shape = words.mix(((first * np.uint64(8) + middle) * np.uint64(8) + last) * np.uint64(2) + same + _ONE)
    cells, owners = [h % np.uint64(CELLS)], [owner]
    for stream, width, size, shift in ((h, 2, CELLS, 0), (shape, 1, SHAPES, CELLS), (shape, 2, SHAPES, CELLS), (shape, 3, SHAPES, CELLS)):
        if len(h) < width:
            continue
        n = len(h) - width + 1
        gram = np.zeros(n, np.uint64)
        for j in range(width):
            gram = words.mix(gram * words._ODD + stream[j : n + j])
        inside = owner[:n] == owner[width - 1 :]
        cells.append((gram[inside] % np.uint64(size)) + np.uint64(shift))
        owners.append(owner[:n][inside])
    return np.concatenate(cells).astype(np.int64), np.concatenate(owners)


def _by_piece(texts):
    data, offsets = words.text_bytes(texts)
    for a, b in words.pieces(offsets):
        cells, owners = _features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        yield a, b, cells, owners


def counts(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every cell in the labelled good texts and in all texts; CELLS + SHAPES rows come to the driver."""
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sampled(labels, sample)), "doc_id", "left")

    def run(batches):
        good, raw = np.zeros(CELLS + SHAPES, np.int64), np.zeros(CELLS + SHAPES, np.int64)
        for batch in batches:
            is_good = np.array([x == 1 for x in batch.column("good").to_pylist()], bool)
            for a, b, cells, owners in _by_piece(batch.column("text")):
                raw += np.bincount(cells, minlength=len(raw))
                good += np.bincount(cells[is_good[a:b][owners]], minlength=len(raw))
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(good[at]), pa.array(raw[at])], ["cell", "good", "raw"])

    summed = marked.select("text", "good").mapInArrow(run, "cell long, good long, raw long").groupBy("cell").agg(F.sum("good").alias("good"), F.sum("raw").alias("raw"))
    good, raw = np.zeros(CELLS + SHAPES), np.zeros(CELLS + SHAPES)
    for row in summed.collect():
        good[row.cell], raw[row.cell] = row.good, row.raw
    return good, raw


def sampled(labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, good (0 or 1): at most `sample` labelled ids, one row each."""
    usable = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").cast("int")).alias("good"))
    return usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def weights(good: np.ndarray, raw: np.ndarray, alpha: float = ALPHA) -> np.ndarray:
    """log(target / raw) of every cell; the two kinds of features are two models."""
    out = np.zeros(len(raw))
    for part in (slice(0, CELLS), slice(CELLS, None)):
        n = len(raw[part])
        target = (good[part] + alpha) / (good[part].sum() + alpha * n)
        base = (raw[part] + alpha) / (raw[part].sum() + alpha * n)
        out[part] = np.log(target) - np.log(base)
    return out


def left_out(cells: np.ndarray, good: np.ndarray, raw: np.ndarray, alpha: float = ALPHA) -> float:
    """The log weight of one text of the target by the model of all others: its own n-grams (cells) are taken out of `good`."""
    held, own = np.unique(cells, return_counts=True)
    total = 0.0
    for low, high in ((0, CELLS), (CELLS, len(raw))):
        inside = (held >= low) & (held < high)
        at, n = held[inside], own[inside]
        target = (good[at] - n + alpha) / (good[low:high].sum() - n.sum() + alpha * (high - low))
        base = (raw[at] + alpha) / (raw[low:high].sum() + alpha * (high - low))
        total += float((n * (np.log(target) - np.log(base))).sum())
    return total


def held_out_weights(docs: DataFrame, good: np.ndarray, raw: np.ndarray, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """log_weight of every labelled good text of the sample, by the model of all other texts."""
    shared = docs.sparkSession.sparkContext.broadcast((good, raw))  # CELLS + SHAPES numbers each
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sampled(labels, sample).where("good = 1")), "doc_id")

    def run(batches):
        for batch in batches:
            found = []
            for a, b, cells, owners in _by_piece(batch.column(0)):
                order = np.argsort(owners, kind="stable")
                cuts = np.cumsum(np.bincount(owners, minlength=b - a))[:-1]
                found += [left_out(own, *shared.value) for own in np.split(cells[order], cuts)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64())], ["log_weight"])

    return marked.select("text").mapInArrow(run, "log_weight double")


def scored(docs: DataFrame, table: np.ndarray, seed: str = "quality-1:") -> DataFrame:
    """The rows of docs with log_weight and key."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(table)  # CELLS + SHAPES numbers
    name = next(n for n in (f"_w{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", `{name}` double"

    def run(batches):
        for batch in batches:
            total = np.zeros(batch.num_rows)
            for a, b, cells, owners in _by_piece(batch.column("text")):
                total[a:b] = np.bincount(owners, weights=shared.value[cells], minlength=b - a)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total)], [*batch.schema.names, name])

    found = docs.mapInArrow(run, schema)
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    return found.select(*docs.columns, F.col(name).alias("log_weight"), (F.col(name) - F.log(-F.log(u))).alias("key"))


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column of finite doubles, by a histogram that is narrowed until a bin holds one value."""
    low, high = rows.select(F.min(column), F.max(column)).first()
    while low < high:
        inside = rows.where((F.col(column) >= low) & (F.col(column) <= high))
        width = (high - low) / BINS
        if width <= 0 or low + width <= low:
            # neighbouring doubles: fewer different values than bins, each its own bin
            bins = inside.groupBy(F.col(column).alias("lo")).agg(F.count("*").alias("n"), F.max(column).alias("hi")).collect()
        else:
            place = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(BINS - 1)).cast("int")
            bins = inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        for row in sorted(bins, key=lambda r: -r.lo):
            if k <= row.n:
                low, high = row.lo, row.hi
                break
            k -= row.n
    return high


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, keep: float = KEEP) -> tuple[np.ndarray, float, DataFrame]:
    """The weights, the smallest key that stays, and doc_id, log_weight, key of every row (written to the shared folder)."""
    good, raw = counts(docs, labels, sample)
    table = weights(good, raw) if good.sum() else np.zeros(CELLS + SHAPES)
    rows = stored(scored(docs.select("doc_id", "text"), table).select(F.col("doc_id").cast("long").alias("doc_id"), "log_weight", "key"), "scored")
    if not good.sum():
        return table, -float("inf"), rows
    targets = stored(held_out_weights(docs, good, raw, labels, sample), "marks")
    mark = kth_largest(targets, "log_weight", max(1, int(np.ceil(targets.count() * keep))))
    k = rows.where(F.col("log_weight") >= mark).count()
    return table, kth_largest(rows.select("key"), "key", k), rows


def quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, log_weight, key, kept."""
    _, least, rows = fitted(docs.select("doc_id", "text"), labels, **options)
    return rows.withColumn("kept", F.col("key") >= F.lit(least))


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs that the resampling keeps; texts are scored again rather than written with their keys."""
    given = apart(docs, "doc_id", "text")
    table, least, _ = fitted(given, labels, **options)
    return scored(given, table).where(F.col("key") >= F.lit(least)).select(*given.columns).toDF(*docs.columns)
