"""Importance resampling towards a target text: array-scored weights, and an exact cutoff by weighted medians of medians.

Words are runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] after lower-casing A-Z; features are all runs of 1 to 3 words joined by one
blank, repeats counted; a feature falls into the bucket crc32(its bytes) mod `buckets`. The gain of a bucket is the logarithm
of its share in the target over its share in the raw texts, in thousandths, rounded down. The weight of a text is the sum of the
gains of its features, the score its weight plus Gumbel noise from a digest of seed and id, and `percent` of the texts with at
least `least_words` words are drawn: those of the highest scores, ties to the smaller id.

1. Counts. A task adds up one array of `buckets` numbers; the arrays (fixed size) meet at the driver. The CRC of a run of words
   goes on from the CRC of the run without its last word, one byte place of all words at a time, so no string is ever made.
2. Weights. The array of gains goes to the tasks, which score whole texts by sums over arrays.
3. Cutoff. Each part of the score table (a split of its files) reports the median of the keys still in question and their number;
   the median of those medians, weighted by the numbers, is the next pivot. At least a quarter of the keys in question
   lies on either side of it, so each round discards a quarter or more, until the pivot is the key with exactly the wanted
   rank. The table in question is written anew whenever it has shrunk to an eighth. The driver sees one row per part and round.
4. Winners (percent of all) are sorted by ranges, equal rows counted first, and numbered; the others keep no rank.

Defined cases: a null text has no words; texts without features have weight 0; a null id draws noise like the text 'null' and
ranks after all others; rows that repeat id and text are rows of their own, next to each other in rank; without target texts all shares
of the target are alike; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgraph.llm import words
from flowgraph.llm.common import stored

BUCKETS = 10_000
PERCENT = 5
LEAST_WORDS = 20
WIDTH = 3
# Words longer than this many bytes are taken one by one.
LONG = 48
LAST_ID = 2**63 - 1

_LETTER = np.zeros(256, bool)
_LETTER[0x30:0x3A] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


# --- features ------------------------------------------------------------------------------------------------

def letter_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word of the texts in data (lower case already), and the text it belongs to."""
    inside = _LETTER[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~border[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~border[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


class _Appender:
    """Continues CRC states by the bytes of words, a state per word."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        sizes = ends - starts
        self.data, self.order = data, np.argsort(-sizes, kind="stable")
        self.starts, sizes = starts[self.order], sizes[self.order]
        self.long = [(i, int(self.starts[i]), int(self.starts[i] + sizes[i])) for i in range(int(np.searchsorted(-sizes, -LONG, side="left")))]
        self.first = len(self.long)
        self.active = [int(np.searchsorted(-sizes, -j, side="left")) for j in range(int(min(LONG, sizes.max(initial=0))))]

    def __call__(self, states: np.ndarray) -> np.ndarray:
        out = states[self.order]
        for i, a, b in self.long:
            out[i] = zlib.crc32(self.data[a:b].tobytes(), int(out[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
        for j, m in enumerate(self.active):
            some = slice(self.first, m)
            out[some] = _CRC[(out[some] ^ self.data[self.starts[some] + j]) & 0xFF] ^ (out[some] >> np.uint32(8))
        back = np.empty_like(out)
        back[self.order] = out
        return back


def features(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS):
    """Bucket of every feature of the texts and the text each belongs to, for each width; and the number of words per text."""
    starts, ends, owner = letter_spans(data, offsets)
    append = _Appender(data, starts, ends)
    found, state = [], np.full(len(starts), 0xFFFFFFFF, np.uint32)
    for width in range(1, WIDTH + 1):
        if width > 1:
            # the run that ends one word before, then a blank
            state = np.concatenate([state[:1], state[:-1]])
            state = _CRC[(state ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (state >> np.uint32(8))
        state = append(state)
        whole = np.zeros(len(owner), bool)
        whole[width - 1 :] = owner[width - 1 :] == owner[: max(0, len(owner) - width + 1)]
        found.append((((state ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64)[whole], owner[whole]))
    return found, np.bincount(owner, minlength=len(offsets) - 1)


def _by_piece(texts, buckets: int):
    data, offsets = words.text_bytes(texts)
    for a, b in words.pieces(offsets):
        part = words._LOWER[data[offsets[a] : offsets[b]]]
        yield a, b, *features(part, offsets[a : b + 1] - offsets[a], buckets)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; `buckets` rows come to the driver."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, found, _ in _by_piece(batch.column(0), buckets):
                for cells, _ in found:
                    total += np.bincount(cells, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target share to raw share per bucket, rounded down."""
    n = len(raw)
    S, T = float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (S + n) / ((s + 1.0) * (T + n)))) for s, t in zip(raw, target)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_features, n_words, weight for every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    buckets = len(gain)

    def run(batches):
        for batch in batches:
            n, sizes, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for a, b, found, counts in _by_piece(batch.column(1), buckets):
                sizes[a:b] = counts
                for cells, owner in found:
                    n[a:b] += np.bincount(owner, minlength=b - a)
                    sums = np.concatenate([[0], np.cumsum(shared.value[cells])])
                    ends = np.cumsum(np.bincount(owner, minlength=b - a))
                    weight[a:b] += np.diff(sums[np.concatenate([[0], ends])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(sizes), pa.array(weight)], ["doc_id", "n_features", "n_words", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_features long, n_words long, weight long")


def noise(seed: int):
    """Gumbel noise in thousandths, rounded down, from a digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


# --- cutoff --------------------------------------------------------------------------------------------------

# A key is (score, id, n_features); it is better with a larger score, then a smaller id, then fewer features.
Key = tuple[int, int, int]


def _middle(keys: np.ndarray) -> list[int]:
    """The middle row of keys (columns -score, id, n_features) in their order."""
    order = np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0]))
    return [int(x) for x in keys[order[(len(keys) - 1) // 2]]]


def _compared(keys: np.ndarray, pivot: Key) -> np.ndarray:
    """-1 where a key comes before the pivot, 0 where it is the pivot, 1 where it comes after."""
    out = np.zeros(len(keys), np.int8)
    for c, value in enumerate(pivot):
        undecided = out == 0
        column = keys[undecided, c]
        out[undecided] = (column > value).astype(np.int8) - (column < value).astype(np.int8)
    return out


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    """The first key, in order, at which the numbers summed so far reach half of all."""
    total, seen = sum(n for _, n in medians), 0
    for key, n in sorted(medians):
        seen += n
        if 2 * seen >= total:
            return key
    raise ValueError("no medians")


def _round(rows: DataFrame, low: Key | None, high: Key | None, pivot: Key | None):
    """Per part of rows, of the keys strictly between low and high: how many lie before, at and after the pivot, and the medians
    of those before and after. Without a pivot all lie before."""

    def run(batches):
        held = [np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)], axis=1) for batch in batches]
        keys = np.concatenate(held) if held else np.zeros((0, 3), np.int64)
        if low is not None:
            keys = keys[_compared(keys, low) > 0]
        if high is not None:
            keys = keys[_compared(keys, high) < 0]
        side = _compared(keys, pivot) if pivot is not None else np.full(len(keys), -1, np.int8)
        rows = [(s, int((side == s).sum()), _middle(keys[side == s]) if s and (side == s).any() else [0, 0, 0]) for s in (-1, 0, 1)]
        rows = [r for r in rows if r[1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), *(pa.array([r[2][c] for r in rows], pa.int64()) for c in range(3))],
            ["side", "n", "k0", "k1", "k2"],
        )

    found: dict[int, list] = {-1: [], 0: [], 1: []}
    for row in rows.mapInArrow(run, "side int, n long, k0 long, k1 long, k2 long").collect():
        found[row.side].append(((row.k0, row.k1, row.k2), row.n))
    return found


def cutoff(rows: DataFrame, k: int) -> Key | None:
    """The k-th key (from 1) of rows (three long columns without nulls, ascending order), by weighted medians of medians; None
    where there are fewer keys. A split of the rows' files is held by a task, 24 bytes a row."""
    low = high = None
    sides = _round(rows, None, None, None)[-1]
    remaining = sum(n for _, n in sides)
    if not 1 <= k <= remaining:
        return None
    written = remaining
    while True:
        pivot = weighted_median(sides)
        found = _round(rows, low, high, pivot)
        before, equal = (sum(n for _, n in found[s]) for s in (-1, 0))
        if before < k <= before + equal:
            return pivot
        if k <= before:
            high, sides = pivot, found[-1]
        else:
            low, sides = pivot, found[1]
            k -= before + equal
        remaining = sum(n for _, n in sides)
        if remaining * 8 <= written:
            rows, written = stored(_between(rows, low, high), "keys"), remaining


def _after(pivot: Key):
    """Whether a row's key comes after the pivot."""
    a, b, c = (F.col(x) for x in ("k0", "k1", "k2"))
    return (a > pivot[0]) | ((a == pivot[0]) & ((b > pivot[1]) | ((b == pivot[1]) & (c > pivot[2]))))


def _between(rows: DataFrame, low: Key | None, high: Key | None) -> DataFrame:
    if low is not None:
        rows = rows.where(_after(low))
    if high is not None:
        a, b, c = (F.col(x) for x in ("k0", "k1", "k2"))
        rows = rows.where((a < high[0]) | ((a == high[0]) & ((b < high[1]) | ((b == high[1]) & (c < high[2])))))
    return rows


def ranked(winners: DataFrame, order: list[str], k: int) -> DataFrame:
    """winners, with equal rows counted before they are sorted by ranges, and `rank` 1, 2, ...; ranks beyond k are null."""
    alike = winners.groupBy(*winners.columns).agg(F.count("*").alias("_copies"))
    # The parts are written before use, so that a lost executor cannot change them.
    parts = stored(alike.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "winners")
    # One row per part.
    sizes = parts.groupBy("_part").agg(F.sum("_copies").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = parts.withColumn("_in", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(F.broadcast(offsets), "_part")
    each = first.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    place = F.col("_before") + F.col("_in") + F.col("_copy")
    return each.select(*winners.columns, F.when(place <= k, place).cast("long").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, seed: int = 42, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_features, n_words, weight, score, rank (1 for the highest score; null where not drawn) for every row of docs."""
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = stored(weighed(docs, gain).withColumn("score", F.col("weight") + noise(seed)), "scored")
    keyed = scored.withColumn("k0", -F.col("score")).withColumn("k1", F.coalesce("doc_id", F.lit(LAST_ID))).withColumn("k2", F.col("n_features"))
    eligible = F.col("n_words") >= least_words
    k = percent * scored.where(eligible).count() // 100
    last = cutoff(keyed.where(eligible).select("k0", "k1", "k2"), k)
    columns = ["doc_id", "n_features", "n_words", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if last is None:
        return scored.select(*columns, none)
    inside = eligible & ~_after(last)
    best = ranked(keyed.where(inside), ["k0", "k1", "k2"], k)
    return keyed.where(~inside).select(*columns, none).unionByName(best.select(*columns, "rank"))


ORACLE = r"""
with texts as (select 'd' as kind, doc_id as id, text from documents union all select 'b', item_id, text from benchmark),
w as materialized (select kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
f as materialized (
  select kind, id, unnest(w) as f from w
  union all select kind, id, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) from w
  union all select kind, id, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) from w),
b as materialized (select f, xor(list_reduce([('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::bigint for i in range(octet_length(encode(f)))],
    lambda c, x: xor(c >> 8, CRC_TABLE[(xor(c, x) & 255) + 1]), 4294967295::bigint), 4294967295) % 10000 as bucket
  from (select distinct f from f)),
c as (select bucket, sum(case when kind = 'd' then 1 else 0 end) as s, sum(case when kind = 'b' then 1 else 0 end) as t from f join b using (f) group by bucket),
tot as (select coalesce(sum(s), 0) as s_all, coalesce(sum(t), 0) as t_all from c),
g as (select bucket, cast(floor(1000 * ln((t + 1)::double * (s_all + 10000)::double / ((s + 1)::double * (t_all + 10000)::double))) as bigint) as gain from c, tot),
x as (select id, count(*) as n_features, cast(sum(gain) as bigint) as weight from f join b using (f) join g using (bucket) where kind = 'd' group by id),
d as (select w.id as doc_id, len(w) as n, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
  coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast(('0x' || substr(sha256('42:' || w.id), 1, 8)) as bigint)::double + 0.5) / 4294967296))) as bigint) as score
  from w left join x on x.id = w.id where kind = 'd'),
r as (select *, n >= 20 as eligible, row_number() over (partition by n >= 20 order by score desc, doc_id) as place from d)
select doc_id, n_features, weight, score, case when eligible and place <= (select 5 * count(*) // 100 from r where eligible) then place end as rank from r
""".replace("CRC_TABLE", "(" + str([int(x) for x in _CRC]) + "::bigint[])")
