"""Near-duplicate groups by an exact Jaccard self-join on word shingles, vertically partitioned.

Two documents link when 100 * |A and B| >= percent * |A or B| for their shingle sets A, B. Shingles have one global order
(that of their 64-bit hashes), which is cut into fragments; a set falls into one segment per fragment.

1. Sets that are equal form one class and are handled once.
2. Candidates. Linked sets of a and b shingles differ in at most d = (a + b)(100 - percent) / (100 + percent) shingles. Of
   d + 1 + t fragments (t is an eighth of d + 1, and one) at least t + 1 hold the same segment of both. So it is enough that each set
   indexes d + 1 of its segments, if all sets leave out the last ones in one and the same order (two sets whose common segments
   were all left out by one of them would have at most t in common): the segments that most classes share are left out, empty ones
   before all others. A set that shares at most t segments with any others indexes none. So unrelated texts
   with a frequent passage, which have a small segment in common, never meet. Sizes are cut into ranges so wide that partners
   lie in the same or the next range; a set sends its segments under the fragments of its own range and of the range before.
3. Overlaps. A pair whose segment sizes (in 64 fragments) or parities alone rule a link out is dropped: both are lower
   bounds of what two sets differ in. A set has at least as many parity cells as shingles, so long texts are told apart as
   well as short ones; of two sets the one with more cells is folded to the other's number. For the others the common shingles are counted fragment by fragment (FRAGMENTS fragments) as separate rows and summed per pair.
4. Of the classes that share a segment each is first compared with one of them only, the one with which it shares most,
   which makes at most as many pairs as classes. Connected classes need no further comparison. Where a group still holds more than one component, all pairs between
   components follow: as pairs in groups up to SMALL classes, else as tiles of TILE x TILE classes. A tile first meets with
   the parities only; the sets follow for classes that still may link, and their overlaps are counted in the task, fragment by fragment, and which return a spanning forest of their links only. So no component is left in parts, and a
   group of near copies makes no square of rows.
5. Links. The numbers of links come from a last comparison of each component with itself, as pairs or in tiles that return a
   number per class: linked classes are in one component, so every link is counted, once.

Class ids are 64-bit hashes of whole sets; two different shingles or sets agree by chance with probability 2**-64.

Defined cases: a null or empty text has an empty set and is linked with nothing; with fewer than k words the whole sequence
is the one shingle; rows that repeat an id are separate rows of one component when their sets link; a null id never
becomes a component's smallest id; a component of null ids only has a null id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgraph.llm import words
from flowgraph.llm.common import apart, bit_table, has_bit, stored
from flowgraph.llm.links import components

FRAGMENTS = 8
SMALL = 32
TILE = 256
CELLS = 1 << 23
_COLUMNS = 4096
# Fewest parity cells of a set; a power of two.
LEAST_CELLS = 1024


def ranges_up_to(n: int, percent: int) -> list[int]:
    """Upper ends of the size ranges 1..h0, h0+1..h1, ... until one reaches n; partners lie in the same or the next range."""
    ends, low = [], 1
    while not ends or ends[-1] < n:
        ends.append(low * 100 // percent)
        low = ends[-1] + 1
    return ends


def fragments_for(apart: int) -> int:
    """Into how many fragments the order is cut where linked sets differ in at most `apart` shingles."""
    return apart + 2 + (apart + 1) // 8


def segment_hashes(hashes: np.ndarray, ends: list[int], percent: int) -> tuple[np.ndarray, list[int]]:
    """The segment hashes that a sorted set sends, for its own range of sizes and then the one before, and [how many are of its
    own range, how many segments need not be indexed in its own range, in the one before]. Hashes of empty segments are odd."""
    own = int(np.searchsorted(ends, len(hashes)))
    mixed = words.mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    out, spare = [], []
    for scheme in (own, own - 1):
        # the smaller partner has at most ends[scheme] shingles, so the two differ in at most `apart`; where that is none, only equal
        # sets link, and those are one class
        apart = ends[scheme] * (100 - percent) // percent if scheme >= 0 else 0
        if apart == 0:
            out.append(np.zeros(0, np.uint64))
            spare.append(0)
            continue
        parts = fragments_for(apart)
        at = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        salt = words.mix((np.uint64(scheme) << np.uint64(32)) + at[first] + np.uint64(1))
        sent = words.mix(np.add.reduceat(mixed, first) + salt) & ~np.uint64(1)
        if len(first) <= apart:
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), at[first])
            sent = np.concatenate([sent, words.mix((np.uint64(scheme) << np.uint64(32)) + empty + np.uint64(1)) | np.uint64(1)])
        out.append(np.unique(sent))
        spare.append(max(0, len(first) - apart - 1))
    return np.concatenate(out), [len(out[0]), *spare]


def parities(hashes: np.ndarray) -> np.ndarray:
    """For each of at least len(hashes) cells whether the set holds an odd number of its shingles, as longs.

    A cell with different parities holds at least one shingle that only one of two sets has, so the number of such cells
    never exceeds the size of the symmetric difference. The number of cells is a power of two: halves laid over each other
    by exclusive or give the parities of half as many cells.
    """
    many = max(LEAST_CELLS, 1 << max(0, len(hashes) - 1).bit_length())
    cells = ((hashes >> np.uint64(16)) % np.uint64(many)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=many) & 1).astype(np.uint8)).view(np.int64)


def folded(bits: np.ndarray, longs: int) -> np.ndarray:
    """Parities folded to fewer cells (64 to a long)."""
    return np.bitwise_xor.reduce(np.asarray(bits, np.int64).reshape(-1, longs), axis=0)


def _class_of(hashes: np.ndarray) -> int:
    total = words.mix(np.add.reduce(words.mix(hashes), keepdims=True) + np.uint64(len(hashes)))
    return int(total.view(np.int64)[0])


def _sets(texts, k: int):
    for a, b, hashes, counts in words.word_hashes(texts):
        for i in range(b - a):
            yield a + i, words.shingles(hashes[counts[i] : counts[i + 1]], k)


def _text_hash():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, th (hash of the text), n (set size), cls (null for an empty set), sent (segment hashes), heads (see segment_hashes), lens (sizes of 64 segments), bits (parities): a row per document.

    A task sends the segments of a class once; copies carry no segments.
    """

    def run(batches):
        ends, seen = [1], set()
        for batch in batches:
            n, cls, sent, heads, lens, bits = [], [], [], [], [], []
            for _, hashes in _sets(batch.column(1), k):
                if len(hashes) > ends[-1]:
                    ends = ranges_up_to(2 * len(hashes), percent)
                n.append(len(hashes))
                cls.append(_class_of(hashes) if len(hashes) else None)
                lens.append(np.bincount((hashes >> np.uint64(58)).astype(np.int64), minlength=64).astype(np.int32))
                bits.append(parities(hashes))
                fresh = len(hashes) and cls[-1] not in seen
                seen.add(cls[-1])
                segments_of, head = segment_hashes(hashes, ends, percent) if fresh else (np.zeros(0, np.uint64), [0, 0, 0])
                sent.append(segments_of.view(np.int64))
                heads.append(head)
            lengths = np.concatenate([[0], np.cumsum([len(x) for x in sent])]).astype(np.int32)
            flat = pa.array(np.concatenate(sent) if sent else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.ListArray.from_arrays(pa.array(lengths), flat), pa.array(heads, pa.list_(pa.int32())), pa.array(lens, pa.list_(pa.int32())), pa.array(bits, pa.list_(pa.int64()))],
                ["doc_id", "th", "n", "cls", "sent", "heads", "lens", "bits"],
            )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_hash().alias("th"))
    return read.mapInArrow(run, "doc_id long, th long, n long, cls long, sent array<long>, heads array<int>, lens array<int>, bits array<long>")


def segments(docs: DataFrame, k: int) -> DataFrame:
    """cls, n, f, part (sorted shingle hashes): a row per document and fragment that holds some of its shingles."""
    bits = np.uint64(64 - (FRAGMENTS - 1).bit_length())

    def run(batches):
        for batch in batches:
            rows = []
            for _, hashes in _sets(batch.column(0), k):
                if not len(hashes):
                    continue
                at = hashes >> bits
                first = np.concatenate([np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])), [len(hashes)]])
                cls = _class_of(hashes)
                rows += [(cls, len(hashes), int(at[a]), hashes[a:b].view(np.int64)) for a, b in zip(first[:-1], first[1:])]
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.list_(pa.int64()))],
                    ["cls", "n", "f", "part"],
                )

    return docs.select("text").mapInArrow(run, "cls long, n long, f int, part array<long>")


def _linked(overlap, left, right, percent: int):
    return overlap * 100 >= (left + right - overlap) * percent


def _unequal(left, right):
    """In how many cells the parities of two classes differ; 0 where one has more than twice the cells of the other."""
    left, right = (F.col(x) if isinstance(x, str) else x for x in (left, right))

    def differ(one, two):
        return F.aggregate(F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda x, y: x + y)

    def half(bits):
        n = (F.size(bits) / 2).cast("int")
        return F.zip_with(F.slice(bits, F.lit(1), n), F.slice(bits, n + 1, n), lambda x, y: x.bitwiseXOR(y))

    a, b = F.size(left), F.size(right)
    return F.when(a == b, differ(left, right)).when(a == b * 2, differ(half(left), right)).when(b == a * 2, differ(left, half(right))).otherwise(0)


def possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose segment sizes and parities allow a link: two lower bounds of what sets differ in."""
    left = classes.select(F.col("cls").alias("a"), F.col("n").alias("a_n"), F.col("lens").alias("a_lens"), F.col("bits").alias("a_bits"))
    right = classes.select(F.col("cls").alias("b"), F.col("n").alias("b_n"), F.col("lens").alias("b_lens"), F.col("bits").alias("b_bits"))
    sized = pairs.join(left, "a").join(right, "b")
    apart = F.aggregate(F.zip_with("a_lens", "b_lens", lambda x, y: F.abs(x - y)), F.lit(0), lambda x, y: x + y)
    most = F.floor((F.col("a_n") + F.col("b_n") - F.greatest(apart, _unequal("a_bits", "b_bits"))) / 2)
    return sized.where(_linked(most, F.col("a_n"), F.col("b_n"), percent)).select("a", "b")


def close_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components in groups of at most SMALL rows (sig, cls, comp, n, bits) that parities allow to link."""
    grouped = rows.groupBy("sig").agg(F.collect_list(F.struct("cls", "comp", "n", "bits")).alias("g"))
    one = grouped.select("g", F.explode("g").alias("x"))
    x = F.col("x")

    def close(y):
        sized = (y["n"] * 100 >= x["n"] * percent) & (x["n"] * 100 >= y["n"] * percent)
        most = F.floor((x["n"] + y["n"] - _unequal(x["bits"], y["bits"])) / 2)
        return (y["cls"] > x["cls"]) & (y["comp"] != x["comp"]) & sized & _linked(most, x["n"], y["n"], percent)

    return one.select(x["cls"].alias("a"), F.explode(F.filter("g", close)).alias("y")).select("a", F.col("y.cls").alias("b")).distinct()


def tile_survivors(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """The rows of a tile (columns cls, n, comp, side, bits) that have a partner of another component that parities allow to link."""
    frame = frame.sort_values(["side", "cls"], kind="stable").drop_duplicates(["side", "cls"])
    left, right = np.flatnonzero(frame["side"] != 2), np.flatnonzero(frame["side"] != 1)
    longs = min(len(x) for x in frame["bits"])
    packed = np.stack([folded(x, longs) for x in frame["bits"]]).view(np.uint8)
    n, comp = frame["n"].to_numpy(np.int64), frame["comp"].to_numpy()
    unequal = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, packed.shape[1], _COLUMNS // 8):
        bits = np.unpackbits(packed[:, start : start + _COLUMNS // 8], axis=1).astype(np.float32)
        ones = bits.sum(1)
        unequal += np.rint(ones[left][:, None] + ones[right][None, :] - 2 * (bits[left] @ bits[right].T)).astype(np.int64)
    a_n, b_n = n[left][:, None], n[right][None, :]
    close = _linked((a_n + b_n - unequal) // 2, a_n, b_n, percent) & (comp[left][:, None] != comp[right][None, :])
    kept = np.zeros(len(frame), bool)
    kept[left[close.any(1)]] = True
    kept[right[close.any(0)]] = True
    return frame[kept]


def verified(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) of classes those that link: overlaps counted per fragment and summed per pair."""
    left = parts.select(F.col("cls").alias("a"), F.col("n").alias("a_n"), "f", F.col("part").alias("a_part"))
    right = parts.select(F.col("cls").alias("b"), F.col("n").alias("b_n"), "f", F.col("part").alias("b_part"))
    common = pairs.join(left, "a").join(right, ["b", "f"]).select("a", "b", "a_n", "b_n", F.size(F.array_intersect("a_part", "b_part")).cast("long").alias("common"))
    summed = common.groupBy("a", "b").agg(F.sum("common").alias("overlap"), F.max("a_n").alias("a_n"), F.max("b_n").alias("b_n"))
    return summed.where(_linked(F.col("overlap"), F.col("a_n"), F.col("b_n"), percent)).select("a", "b")


def _tile_linked(frame: pd.DataFrame, percent: int) -> tuple[pd.DataFrame, pd.DataFrame, np.ndarray]:
    """The two sides of a tile (columns cls, n, side, part; side 0 is on both) and which of their rows link."""
    frame = frame.sort_values(["side", "cls"], kind="stable").drop_duplicates(["side", "cls"])
    left, right = frame[frame["side"] != 2], frame[frame["side"] != 1]
    hashes = np.concatenate([np.concatenate([left, right]) for left, right in [(np.concatenate(list(left["part"])) if len(left) else np.zeros(0, np.int64), np.concatenate(list(right["part"])) if len(right) else np.zeros(0, np.int64))]])
    values, places = np.unique(hashes, return_inverse=True)
    a_rows, b_rows = np.repeat(np.arange(len(left)), left["n"]), np.repeat(np.arange(len(right)), right["n"])
    a_at, b_at = places[: len(a_rows)], places[len(a_rows) :]
    shared = np.flatnonzero((np.bincount(a_at, minlength=len(values)) > 0) & (np.bincount(b_at, minlength=len(values)) > 0))
    overlap = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(shared), _COLUMNS):
        # one fragment of the order: the columns of some thousand shingles that both sides hold
        chosen = shared[start : start + _COLUMNS]
        column = np.full(len(values), -1)
        column[chosen] = np.arange(len(chosen))
        one, two = np.zeros((len(left), len(chosen)), np.float32), np.zeros((len(right), len(chosen)), np.float32)
        inside = column[a_at] >= 0
        one[a_rows[inside], column[a_at[inside]]] = 1
        inside = column[b_at] >= 0
        two[b_rows[inside], column[b_at[inside]]] = 1
        overlap += one @ two.T
    common = np.rint(overlap).astype(np.int64)
    a_n, b_n = left["n"].to_numpy(np.int64)[:, None], right["n"].to_numpy(np.int64)[None, :]
    return left, right, _linked(common, a_n, b_n, percent)


def tile_counts(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """cls, links: with how many other classes of one tile each of its classes links."""
    left, right, linked = _tile_linked(frame, percent)
    a_ids, b_ids = left["cls"].to_numpy(), right["cls"].to_numpy()
    linked &= a_ids[:, None] != b_ids[None, :]
    out = pd.DataFrame({"cls": a_ids, "links": linked.sum(1)})
    if (frame["side"] != 0).any():
        out = pd.concat([out, pd.DataFrame({"cls": b_ids, "links": linked.sum(0)})])
    return out[out["links"] > 0].astype("int64")


def tile_links(frame: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between classes of different components in one tile (columns cls, n, comp, side, part)."""
    left, right, linked = _tile_linked(frame, percent)
    apart = left["comp"].to_numpy()[:, None] != right["comp"].to_numpy()[None, :]
    rows, cols = np.nonzero(linked & apart)
    a_ids, b_ids, a_comp, b_comp = left["cls"].to_numpy(), right["cls"].to_numpy(), left["comp"].to_numpy(), right["comp"].to_numpy()
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in zip(rows, cols):
        x, y = find(a_comp[i]), find(b_comp[j])
        if x != y:
            root[x] = y
            out.append((int(a_ids[i]), int(b_ids[j])))
    return out


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()


def _parts(docs: DataFrame, k: int, classes: DataFrame, needed: DataFrame) -> DataFrame:
    """The segments of the needed classes, from one document of each: others are told apart by a bit table, not shuffled."""
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(CELLS))
    chosen = classes.join(needed, "cls", "left_semi").select(F.col("rep").alias("doc_id"))
    celled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_cell", cell)
    wanted = has_bit(celled, "_cell", bit_table(chosen.select(cell.alias("_cell")), "_cell"), "_wanted").where("_wanted")
    return stored(segments(wanted, k).join(needed, "cls", "left_semi").dropDuplicates(["cls", "f"]), "parts")


def _tiles(rows: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The rows (sig, cls, comp, m, top, g) of groups dealt to tiles of TILE x TILE classes, without those that parities allow no link in their tile.

    g of a group's m classes are in its largest component, top. They need not meet each other: where the other components
    fill one block, every class of top is in one row, however many there are.
    """
    rest, large = (F.ceil(x / TILE).cast("int") for x in (F.col("m") - F.col("g"), F.col("g")))
    inside = F.col("comp").eqNullSafe(F.col("top"))
    place = F.when(inside, rest + F.pmod(F.xxhash64("cls"), large).cast("int")).otherwise(F.pmod(F.xxhash64("cls"), rest).cast("int"))
    at = rows.withColumn("block", place).withColumn("last", F.when(inside, rest - 1).otherwise(rest + large - 1))
    at = at.withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
    tiled = at.select(
        "sig", "cls", "comp",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"),
    )

    def survivors(frame: pd.DataFrame) -> pd.DataFrame:
        return tile_survivors(frame, percent)[["sig", "cls", "comp", "i", "j", "side"]]

    return tiled.join(sketches, "cls").groupBy("sig", "i", "j").applyInPandas(survivors, "sig long, cls long, comp long, i int, j int, side int")


def _whole(parts: DataFrame, rows: DataFrame) -> DataFrame:
    """cls, n, part: the whole sets of the rows' classes."""
    return parts.join(rows.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(F.max("n").alias("n"), F.flatten(F.collect_list("part")).alias("part"))


def link_counts(docs: DataFrame, k: int, found: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """cls, n_links: with how many other classes each class links, counted over all pairs.

    Classes that link are in one component, so a component is compared with itself, once: as pairs up to SMALL classes, else as tiles.
    """
    rows = found.select(F.col("node").alias("cls"), F.col("comp").alias("sig"))
    sized = rows.groupBy("sig").agg(F.count("*").alias("m")).withColumn("top", F.lit(None).cast("long")).withColumn("g", F.lit(0).cast("long"))
    rows = stored(rows.join(sized, "sig").withColumn("comp", F.col("cls")), "compared")
    sketches = classes.select("cls", "n", "bits")
    pairs = close_pairs(rows.where(F.col("m") <= SMALL).select("sig", "cls", "comp").join(sketches, "cls"), percent)
    pairs = stored(possible(pairs, classes, percent), "pairs")
    large = stored(_tiles(rows.where(F.col("m") > SMALL), sketches, percent), "near")
    needed = _ends(pairs).unionByName(large.select("cls")).distinct()
    parts = _parts(docs, k, classes, stored(needed, "needed"))
    counts = verified(pairs, parts, percent).select(F.explode(F.array("a", "b")).alias("cls"), F.lit(1).cast("long").alias("links"))
    if not large.isEmpty():
        tiles = large.join(_whole(parts, large), "cls").groupBy("sig", "i", "j")
        counts = counts.unionByName(tiles.applyInPandas(lambda frame: tile_counts(frame, percent), "cls long, links long"))
    return counts.groupBy("cls").agg(F.sum("links").alias("n_links"))


def _rest(docs: DataFrame, k: int, members: DataFrame, found: DataFrame, tried: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links between classes that share a segment but were left in different components."""
    named = members.join(found.select(F.col("node").alias("cls"), "comp"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    named = stored(named, "named")
    parts_of = named.groupBy("sig", "comp").agg(F.count("*").alias("c")).groupBy("sig").agg(F.count("*").alias("comps"), F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("top"))
    open_groups = parts_of.where("comps > 1").select("sig", "m", F.col("top.comp").alias("top"), F.col("top.c").alias("g"))
    rows = stored(named.join(open_groups, "sig"), "open")
    sketches = classes.select("cls", "n", "bits")
    small = rows.where(F.col("m") <= SMALL).select("sig", "cls", "comp").join(sketches, "cls")
    pairs = close_pairs(small, percent).join(tried, ["a", "b"], "left_anti")
    pairs = stored(possible(pairs, classes, percent), "pairs")
    large = stored(_tiles(rows.where(F.col("m") > SMALL), sketches, percent), "near")
    needed = _ends(pairs).unionByName(large.select("cls")).distinct()
    parts = _parts(docs, k, classes, stored(needed, "needed"))
    links = verified(pairs, parts, percent)
    if large.isEmpty():
        return links
    whole = _whole(parts, large)

    def tile(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(tile_links(frame, percent), columns=["a", "b"], dtype="int64")

    return links.unionByName(large.join(whole, "cls").groupBy("sig", "i", "j").applyInPandas(tile, "a long, b long"))


def _members(sent: DataFrame) -> DataFrame:
    """sig, cls, center: the classes that index a segment (more than one), and the smallest class that sent it."""
    own = F.col("pos") < F.col("heads")[0]
    places = sent.where("cls is not null").select("cls", "heads", F.posexplode("sent").alias("pos", "sig"))
    segments_sent = places.select("cls", "sig", own.alias("own"), F.when(own, F.col("heads")[1]).otherwise(F.col("heads")[2]).alias("spare"))
    # A segment sent by one class only makes no pair. Most are; a bit per hash lets nearly all of them stay where they are.
    shared = segments_sent.groupBy("sig").agg(F.min("cls").alias("low"), F.max("cls").alias("high"), F.count("*").alias("df")).where("low <> high")
    shared = stored(shared.select("sig", "df"), "shared")
    cell = F.pmod(F.xxhash64("sig"), F.lit(CELLS))
    maybe = has_bit(segments_sent.withColumn("_cell", cell), "_cell", bit_table(shared.select(cell.alias("_cell")), "_cell"), "_maybe")
    met = maybe.where("_maybe").drop("_cell", "_maybe").join(shared, "sig").distinct()
    # Of its segments that are not empty a class leaves out the `spare` most frequent ones; equal numbers go by the hash.
    full = F.col("sig").bitwiseAND(F.lit(1)) == 0
    frequent_first = Window.partitionBy("cls", "own", "full").orderBy(F.col("df").desc(), F.col("sig").desc())
    ranked = met.withColumn("full", full).withColumn("place", F.row_number().over(frequent_first))
    indexed = stored(ranked.where(~F.col("full") | (F.col("place") > F.col("spare"))).select("sig", "cls"), "indexed")
    groups = indexed.groupBy("sig").agg(F.min("cls").alias("center"), F.max("cls").alias("high")).where("center <> high").select("sig", "center")
    return indexed.join(groups, "sig")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, count_links: bool = True) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, cls, comp, component_id, n_links: a row per row of docs.

    comp tells components apart, also those of the same smallest id (null: an empty set); component_id is the smallest doc_id reachable by links; n_links counts the other
    classes (different shingle sets) that link with the row's class. Without `count_links` the column is left out and the pairs that
    only it needs are not compared.
    """
    sent = stored(signatures(docs, k, percent), "signatures")
    classes = stored(sent.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("lens").alias("lens"), F.max("bits").alias("bits")), "classes")
    members = stored(_members(sent), "members")
    met = members.where("cls <> center").groupBy("cls", "center").agg(F.count("*").alias("m"))
    best = met.groupBy("cls").agg(F.max_by("center", F.struct("m", "center")).alias("center"))
    star = stored(best.select(F.least("cls", "center").alias("a"), F.greatest("cls", "center").alias("b")).distinct(), "star")
    star = stored(possible(star, classes, percent), "possible")
    links = stored(verified(star, _parts(docs, k, classes, _ends(star)), percent), "links")
    found = components(links, "a", "b")
    more = stored(_rest(docs, k, members.select("sig", "cls"), found, star, classes, percent), "more")
    if not more.isEmpty():
        links = links.unionByName(more).distinct()
        found = components(links, "a", "b")
    counts = stored(link_counts(docs, k, found, classes, percent), "counts") if count_links else links.select(F.col("a").alias("cls"), F.lit(None).cast("long").alias("n_links")).limit(0)
    named = classes.select("cls", "rep").join(found.select(F.col("node").alias("cls"), "comp"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    smallest = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    of_class = named.join(smallest, "comp").join(counts, "cls", "left").select("cls", "comp", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    # A class with a third of all rows is spread over salts.
    salts = 16
    spread = of_class.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    full = sent.where("cls is not null").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts))).join(spread, ["cls", "salt"])
    columns = ["doc_id", "th", F.col("n").alias("n_shingles"), "cls", "comp", "component_id", "n_links"]
    bare = sent.where("cls is null").select("doc_id", "th", F.col("n").alias("n_shingles"), "cls", F.col("cls").alias("comp"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    done = full.select(*columns).unionByName(bare)
    return done if count_links else done.drop("n_links")


def one_per_group(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The row of each component with its smallest (doc_id, hash of the text), null ids last; rows that repeat id and text once.

    Each row is decided by its own id and text: other texts of an id, or other rows without an id, are not touched by it.
    """
    groups = stored(near_duplicates(docs.select("doc_id", "text"), k, percent, count_links=False), "groups")
    place = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "th")
    linked = groups.where("comp is not null").select("comp", place.alias("place"))
    first = linked.groupBy("comp").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first <> last")
    drop = linked.join(first, "comp").where("place <> first").select(F.col("place.doc_id").alias("_id"), F.col("place.th").alias("_th")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_th"))
    given = apart(docs, "doc_id", "text")
    kept = given.withColumn("_key", _text_hash()).join(drop, same, "left_anti").drop("_key")
    if not groups.groupBy("doc_id", "th").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept.toDF(*docs.columns)


ORACLE = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as materialized (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct([array_to_string(w[i : i + 2], ' ') for i in range(1, len(w) - 1)]) end as s from w),
u as materialized (select doc_id, len(s) as n, unnest(s) as g from s),
o as (select a.doc_id as a, b.doc_id as b, count(*) as c, any_value(a.n) as an, any_value(b.n) as bn
  from u a join u b on a.g = b.g and a.doc_id <> b.doc_id and a.n * 100 >= b.n * 90 and b.n * 100 >= a.n * 90 group by 1, 2),
l as materialized (select a, b from o where 100 * c >= 90 * (an + bn - c)),
r as (select doc_id, doc_id as other from s union select r.doc_id, l.b from r join l on l.a = r.other)
select s.doc_id, cast(any_value(len(s.s)) as bigint) as n_shingles, min(r.other) as component_id
from s join r on r.doc_id = s.doc_id group by s.doc_id
"""
