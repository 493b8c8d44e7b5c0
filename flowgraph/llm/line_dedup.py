"""Line dedup by pairwise alignment: documents that share a rare line are aligned, and common blocks leave the later one.

A line is what stands between line feeds; lines without words are left out of the comparison and are never deleted. A block
is a run of consecutive lines with at least `min_words` words in all.

1. Anchors. For each line, the shortest run of lines that starts there and has min_words words is hashed (often a single
   line). Two documents with a common block share such a run. Its length makes it rare: short phrases never pair documents.
2. Pairs. Each document is paired with the first document that holds a run (smallest doc_id), per run. That is at most one
   pair per run, also where thousands of documents share one passage, and no block is missed, as the first holder has it.
3. Alignment. Each pair's line hashes are aligned by patience diff: lines that occur once in both, in their longest common
   increasing order, are fixed, the stretches between them are treated likewise, and equal lines next to fixed ones follow.
   Anchor runs the order had to leave out (a passage that moved) are fixed after that.
4. Deletion. Aligned blocks of at least min_words words leave the later document; the earlier one keeps them.

Only hashes and word counts of lines meet in pairs; a hot first holder is repeated per pair with its line hashes only. Of the
texts only those that may lose lines are shuffled, to meet their deletions (a bit table of fixed size tells them apart).

Defined cases: a null text counts as empty and stays null; documents are ordered by doc_id (null first), then by a hash of the
text; rows that repeat id and text are one document, and are changed alike; a later document whose lines are all common
becomes the empty text; an empty table gives no rows; further columns are kept.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgraph.llm.common import WORD, apart, bit_table, has_bit, stored

MIN_WORDS = 50
CELLS = 1 << 23


def lines_of(docs: DataFrame) -> DataFrame:
    """id, th (hash of the text), at (places of lines with words), hashes, sizes (words): a row per different document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("th"), F.split(text, "\n").alias("lines"))
    sized = read.select("id", "th", F.transform("lines", lambda x, i: F.struct(i.alias("at"), F.xxhash64(x).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w"))).alias("all"))
    full = sized.withColumn("all", F.filter("all", lambda x: x["w"] > 0))
    return full.select("id", "th", F.col("all.at").alias("at"), F.col("all.h").alias("hashes"), F.col("all.w").alias("sizes"))


def runs(hashes: np.ndarray, sizes: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """The shortest runs [a, b) with min_words words, for each a that has one."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.searchsorted(total, total[:-1] + min_words, side="left")
    return [(a, int(b)) for a, b in enumerate(ends) if b <= len(sizes)]


def _run_key(hashes: np.ndarray, a: int, b: int) -> int:
    if b == a + 1:
        return int(hashes[a])
    key = 0
    for h in hashes[a:b]:
        key = (key * 6364136223846793005 + int(h) + 1442695040888963407) & (2**64 - 1)
    return key - 2**64 if key >= 2**63 else key


def patience(a, b) -> list[tuple[int, int]]:
    """Pairs (i, j) with a[i] == b[j], ascending in both, by patience diff."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        lo_a, hi_a, lo_b, hi_b = todo.pop()
        while lo_a < hi_a and lo_b < hi_b and a[lo_a] == b[lo_b]:
            out.append((lo_a, lo_b))
            lo_a, lo_b = lo_a + 1, lo_b + 1
        while lo_a < hi_a and lo_b < hi_b and a[hi_a - 1] == b[hi_b - 1]:
            hi_a, hi_b = hi_a - 1, hi_b - 1
            out.append((hi_a, hi_b))
        if lo_a >= hi_a or lo_b >= hi_b:
            continue
        once_a, once_b = _once(a, lo_a, hi_a), _once(b, lo_b, hi_b)
        fixed = _increasing([(i, once_b[x]) for x, i in once_a.items() if x in once_b])
        if not fixed:
            continue
        at_a, at_b = lo_a, lo_b
        for i, j in fixed:
            todo.append((at_a, i, at_b, j))
            out.append((i, j))
            at_a, at_b = i + 1, j + 1
        todo.append((at_a, hi_a, at_b, hi_b))
    return sorted(out)


def _once(lines, low: int, high: int) -> dict:
    """Lines that occur once in the range, and where, in order."""
    where: dict = {}
    for i in range(low, high):
        where[lines[i]] = -1 if lines[i] in where else i
    return {x: i for x, i in where.items() if i >= 0}


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence that also ascends in the second number; the first ascends already."""
    tails: list[int] = []
    top: list[int] = []
    before = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        before.append(top[k - 1] if k else -1)
        if k == len(tails):
            tails.append(j)
            top.append(n)
        else:
            tails[k], top[k] = j, n
    out, n = [], top[-1] if top else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def common_blocks(later, later_sizes, earlier, min_words: int) -> list[int]:
    """Indexes of the later document's lines that lie in aligned blocks of at least min_words words."""
    gone: set[int] = set()
    rest, other = list(range(len(later))), list(range(len(earlier)))
    while rest and other:
        matched = patience([later[i] for i in rest], [earlier[j] for j in other])
        pairs = [(rest[i], other[j]) for i, j in matched]
        block: list[tuple[int, int]] = []
        found: list[tuple[int, int]] = []
        for pair in [*pairs, (-9, -9)]:
            if block and pair != (block[-1][0] + 1, block[-1][1] + 1):
                if sum(later_sizes[i] for i, _ in block) >= min_words:
                    found += block
                block = []
            block.append(pair)
        if not found:
            # nothing in order; a moved or repeated block is fixed by its anchor run, wherever it stands
            found = _moved(later, later_sizes, earlier, rest, min_words)
        if not found:
            break
        gone.update(i for i, _ in found)
        rest = [i for i in rest if i not in gone]
    return sorted(gone)


def _moved(later, sizes, earlier, rest, min_words: int) -> list[tuple[int, int]]:
    """One block that both hold, out of order or held twice by the later document, grown as far as lines agree."""
    free = set(rest)
    sized = np.array(sizes, np.int64)
    hashes = np.array(later, np.int64)
    where: dict = {}
    for j, x in enumerate(earlier):
        where.setdefault(x, []).append(j)
    for a, b in runs(hashes, sized, min_words):
        if not all(i in free for i in range(a, b)):
            continue
        for j in where.get(later[a], ()):
            n = 0
            while a + n in free and j + n < len(earlier) and a + n < len(later) and later[a + n] == earlier[j + n]:
                n += 1
            if n >= b - a:
                return [(a + m, j + m) for m in range(n)]
    return []


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """id, th, gone (places of lines to delete): a row per document that loses lines."""
    lines = stored(lines_of(docs).dropDuplicates(["id", "th"]), "lines")
    as_text = F.col("id").cast("string").alias("id")  # pandas would turn whole numbers with nulls into doubles

    def anchors(batches):
        for frame in batches:
            rows = []
            for doc, th, hashes, sizes in zip(frame["id"], frame["th"], frame["hashes"], frame["sizes"]):
                hashes = np.asarray(hashes, np.int64)
                keys = {_run_key(hashes, a, b) for a, b in runs(hashes, np.asarray(sizes, np.int64), min_words)}
                rows += [(doc, th, key) for key in keys]
            yield pd.DataFrame({"id": [r[0] for r in rows], "th": [r[1] for r in rows], "key": [r[2] for r in rows]}).astype({"id": object, "th": "int64", "key": "int64"})

    found = stored(lines.select(as_text, "th", "hashes", "sizes").mapInPandas(anchors, "id string, th long, key long").withColumn("id", F.col("id").cast("long")), "anchors")
    who = F.struct("id", "th")
    first = found.groupBy("key").agg(F.min(who).alias("first"), F.max(who).alias("last")).where("first <> last").select("key", "first")
    pairs = stored(found.join(first, "key").where(who != F.col("first")).select(who.alias("later"), "first").distinct(), "pairs")
    keyed = lines.withColumn("who", who).drop("id", "th")
    later = keyed.select(F.col("who").alias("later"), "at", F.col("hashes").alias("a"), F.col("sizes").alias("w"))
    earlier = keyed.select(F.col("who").alias("first"), F.col("hashes").alias("b"))
    met = pairs.join(later, "later").join(earlier, "first").select(F.col("later.id").cast("string").alias("id"), "later.th", "at", "a", "w", "b")

    def align(batches):
        for frame in batches:
            rows = []
            for doc, th, at, a, w, b in frame[["id", "th", "at", "a", "w", "b"]].itertuples(index=False):
                places = common_blocks(list(a), list(w), list(b), min_words)
                rows += [(doc, th, int(at[i])) for i in places]
            yield pd.DataFrame({"id": [r[0] for r in rows], "th": [r[1] for r in rows], "place": [r[2] for r in rows]}).astype({"id": object, "th": "int64", "place": "int32"})

    cut = met.mapInPandas(align, "id string, th long, place int").withColumn("id", F.col("id").cast("long"))
    return stored(cut.groupBy("id", "th").agg(F.collect_set("place").alias("gone")), "deletions")


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of docs with `text` after deletion, and the column `deleted_lines` (their number; it takes the place of one
    of that name in docs)."""
    kept = [c for c in docs.columns if c != "deleted_lines"]
    return _deduped(apart(docs.select(*kept), "doc_id", "text"), min_words).toDF(*kept, "deleted_lines")


def _deduped(docs: DataFrame, min_words: int) -> DataFrame:
    gone = deletions(docs, min_words).select(F.col("id").alias("_id"), F.col("th").alias("_th"), F.col("gone").alias("_gone"))
    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(CELLS))
    bits = bit_table(gone.select(cell("_id").alias("_cell")), "_cell")
    marked = has_bit(docs.withColumn("_cell", cell(F.col("doc_id").cast("long"))), "_cell", bits, "_maybe")
    keyed = marked.where("_maybe").withColumn("_key", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_th"))
    joined = keyed.join(gone.hint("merge"), same, "left")
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(left)
    changed = joined.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns], F.coalesce(F.size("_gone"), F.lit(0)).alias("deleted_lines"))
    return marked.where("not _maybe").select(*docs.columns, F.lit(0).alias("deleted_lines")).unionByName(changed)


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with common blocks deleted; documents that lost all their words are left out."""
    given = apart(docs, "doc_id", "text")
    done = _deduped(given, min_words).where((F.col("deleted_lines") == 0) | F.col("text").rlike(WORD))
    return done.select(*given.columns).toDF(*docs.columns)
