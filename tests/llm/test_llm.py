"""The training-data operators against brute force on small tables, with nulls, empty and long texts, ties, repeats, no rows."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from compare import duck, mismatch
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from flowgraph.llm import exact_dedup, jaccard, licenses, line_dedup, links, mixing, packing, quality, suffix_tree, topk, toxicity, words

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, salt string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows, schema=SCHEMA):
    """Documents with two further columns whose names also occur inside operators."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, "x") for i, t, s in rows], schema)


def corpus(seed=1, n=120):
    """Random texts with copies, near copies, shared passages, nulls, empties, one long text, repeated rows, a null id."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeäß") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows, base = [], []
    for i in range(n):
        lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 70))) for _ in range(rng.randint(1, 5))]
        if i % 7 == 0:
            lines.insert(rng.randint(0, len(lines)), passage)
        text = "\n".join(lines)
        if base and i % 4 == 0:
            near = rng.choice(base).split(" ")
            for _ in range(rng.randint(0, 3)):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            text = " ".join(near) + rng.choice(["", "\n", "  "])
        base.append(text)
        rows.append((i, text, rng.choice(["a", "b", "c", None])))
    rows += [(n, None, "a"), (n + 1, "", "b"), (n + 2, " \t\n", None), (n + 3, "One", "a"), (n + 4, "one two", "c"), (n + 5, " ".join(vocabulary * 40), "c")]
    rows += [(n + 6, base[3].upper(), "a"), (n + 7, base[5], "b"), (n + 7, base[5], "b"), (None, base[8], "a")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


# queries over the smallest tables

LLM = [*entry.LLM_QUERIES]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", LLM)
def test_query(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql:
        assert mismatch(df, duck(SF_DIR), sql) is None
    else:
        assert df.count() > 0


# words


def test_words_and_shingles():
    texts = ["Ab cd\x0bEF", None, "", " x ", "ä ö b"]
    found = [[int(h) for h in hashes[counts[i] : counts[i + 1]]] for a, b, hashes, counts in words.word_hashes(texts) for i in range(b - a)]
    assert [len(f) for f in found] == [3, 0, 0, 1, 2]  # no-break space is part of a word
    again = [int(h) for _, _, hashes, _ in words.word_hashes(["ab", "cd ef x"]) for h in hashes]
    assert again == found[0] + found[3]
    assert len(words.shingles(np.array(found[0], np.uint64), 3)) == 1 and len(words.shingles(np.array(found[0], np.uint64), 2)) == 2
    assert len(words.shingles(np.zeros(0, np.uint64), 3)) == 0


# exact dedup


def brute_dedup(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), -1 if i is None else i, i))
    return {(i, sorted(v)[0][2], len(v), hashlib.sha256(k.encode()).hexdigest()) for k, v in groups.items() for _, _, i in v}


@pytest.mark.parametrize("cells", [1 << 24, 8])
def test_exact_dedup(docs, rows, cells):
    got = exact_dedup.exact_dedup(docs, cells).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got} == brute_dedup(rows)
    for sha in {r.text_sha256 for r in got}:
        assert len({r.doc_id for r in got if r.text_sha256 == sha and r.kept}) == 1


def test_exact_dedup_has_no_python(docs):
    plan = exact_dedup.exact_dedup(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, full = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return {**full, **share}
        for s in over:
            full[s] = 2 * sizes[s]
            left -= full[s]


def test_mixing(docs, rows):
    got = mixing.mix_report(docs).collect()
    assert len(got) == len(rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    want = brute_targets(size)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.source_size == size[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-12)
        assert r.copies in (0, 1, 2) and r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in size:
        assert abs(taken[s] - want[s]) <= largest[s]
    again = mixing.mix_report(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_rows(docs):
    copies = Counter()
    for r in mixing.mix_report(docs).collect():
        copies[r.doc_id] += r.copies
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in copies.items() if v})


def test_unequal_probabilities(spark):
    many = frame(spark, [(i, "w " * 10, "abc"[i % 3]) for i in range(600)])
    got = mixing.mix(many, measure=F.when(F.col("doc_id") < 300, 3.0).otherwise(1.0)).where("source = 'b'").collect()
    low, high = [r.copies for r in got if r.doc_id < 300], [r.copies for r in got if r.doc_id >= 300]
    assert sum(low) > sum(high) > 0


def test_inclusion_odds_are_solved_per_source(spark):
    """The constants against a brute-force solution; larger documents are drawn oftener."""
    rng = random.Random(4)
    sizes = [(i, rng.choice([1, 4, 9, 30, 100, 400]), "abc"[i % 3]) for i in range(900)]
    data = frame(spark, [(i, "w " * n, s) for i, n, s in sizes])
    read = data.select("doc_id", "source", F.regexp_count("text", F.lit("w")).cast("long").alias("size"), F.lit(1).cast("long").alias("rows"))
    read = read.withColumn("measure", F.floor(F.sqrt("size")).cast("double"))
    for r in mixing.chances(read, mixing.targets(read)).collect():
        mine = [(n, math.isqrt(n)) for _, n, s in sizes if s == r.source]
        expected = sum(n * (1.0 if r.least is not None and m >= r.least else r.per_measure * m) for n, m in mine)
        assert math.isclose(expected, r.room, rel_tol=1e-9, abs_tol=1e-9)
        assert all((r.least is not None and m >= r.least) or r.per_measure * m < 1 for _, m in mine)
        low, high = 0.0, 2.0
        for _ in range(100):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(n * min(1.0, mid * m) for n, m in mine) < r.room else (low, mid)
        assert all(math.isclose(min(1, low * m), 1 if r.least is not None and m >= r.least else r.per_measure * m, abs_tol=1e-6) for _, m in mine)
    got = mixing.mix(data).where("source = 'b'").collect()
    share = lambda n: sum(r.copies for r in got if r.size == n) / sum(1 for r in got if r.size == n)
    assert share(400) > share(1)


CLASHES = ["key", "log_weight", "_id", "_th", "_gone", "_cell", "_maybe", "_key", "_source", "_size", "_words", "_copies", "_copy",
           "deleted_lines", "kept", "words", "rank", "u", "given_0", "given_3"]


def test_clashing_columns_stay_as_they_are(spark):
    rows, marks = quality_rows(n=60)
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    data = frame(spark, rows + [(900, rows[1][1], "b"), (901, None, None)])
    values = {c: n * 1000 for n, c in enumerate(CLASHES)}
    data = data.select("*", *[(F.col("doc_id") + n).alias(c) for c, n in values.items()])
    for run in (lambda d: quality.good_documents(d, labels), line_dedup.without_repeats, jaccard.one_per_group, mixing.mixed, line_dedup.line_dedup):
        out = run(data)
        ours = ["deleted_lines"] if run is line_dedup.line_dedup else []
        assert sorted(out.columns) == sorted(data.columns)
        found = out.collect()
        assert found and all(r[c] == r.doc_id + n for r in found for c, n in values.items() if c not in ours)


def test_mixing_without_rows_and_words(spark, none):
    assert mixing.mix_report(none).count() == 0
    assert [r.taken for r in mixing.mix_report(frame(spark, [(1, None, "a"), (2, " ", "b")])).collect()] == [0, 0]


# packing


def brute_padding(histogram, buckets):
    lengths = sorted(histogram)
    best = {(0, 0): 0}
    for k in range(1, buckets + 1):
        for j in range(len(lengths) + 1):
            options = [best.get((j, k - 1), math.inf)]
            options += [best.get((i, k - 1), math.inf) + sum((lengths[j - 1] - x) * histogram[x] for x in lengths[i:j]) for i in range(j)]
            best[j, k] = min(options)
    return best[len(lengths), buckets]


@pytest.mark.parametrize("buckets", [1, 2, 3, 5])
def test_boundaries(buckets):
    rng = random.Random(buckets)
    for _ in range(5):
        histogram = {rng.randint(1, 60): rng.randint(1, 9) for _ in range(12)}
        bounds = packing.boundaries(histogram, buckets)
        assert len(bounds) <= buckets and bounds[-1] == max(histogram)
        assert sum((min(b for b in bounds if b >= x) - x) * n for x, n in histogram.items()) == brute_padding(histogram, buckets)
    assert packing.boundaries({0: 5}, 3) == []


def test_pack(docs, rows, none):
    got = packing.pack(docs, buckets=4, budget=600, max_words=500, with_text=True).collect()
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.piece].append(r)
    want = Counter()
    for i, t, _ in rows:
        found = WORD.findall(t or "")
        for k in range(max(1, -(-len(found) // 500))):
            want[i, k, tuple(found[k * 500 : (k + 1) * 500])] += 1
    assert Counter((r.doc_id, r.piece, tuple(WORD.findall(r.text))) for r in got) == want
    batches = defaultdict(list)
    for r in got:
        if r.length == 0:
            assert r.bucket is None and r.batch is None
            continue
        assert r.length <= r.padded
        batches[r.bucket, r.batch].append(r)
    short = Counter()
    for (bucket, _), members in batches.items():
        room = 600 // members[0].padded
        assert sorted(m.slot for m in members) == list(range(len(members))) and len(members) <= room
        short[bucket] += len(members) < room
    assert max(short.values()) <= 1
    assert packing.pack(none).count() == 0


# top-k


def brute_topk(vectors, k=5):
    usable = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in vectors.items() if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, v in usable.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable.items() if i != q and len(w) == len(v))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    return out


@pytest.mark.parametrize("sizes", [(1024, 8192), (2, 16)])
def test_topk(spark, sizes):
    rng = random.Random(3)
    vectors = {i: [rng.choice([-0.5, 0.25, 0.25, 1.0]) for _ in range(3)] for i in range(220)}
    vectors |= {50: None, 51: [], 52: [1.0, None, 1.0], 53: [float("nan"), 0.0, 0.0], 54: [float("inf"), 0.0, 0.0], 100: [1.0, 2.0], 101: [3.0, 4.0], None: [9.0, 9.0, 9.0]}
    data = list(vectors.items()) + [(7, vectors[7])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in data], "vec_id bigint, embedding array<float>, id string, s int")
    got = topk.topk(df, F.col("id") % 50 == 0, block=sizes[0], shard=sizes[1]).collect()
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == brute_topk(vectors)
    assert topk.topk(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_topk_beyond_double(spark):
    data = {0: [3e9, 1e9], 1: [3e9, 1.0], 2: [3e9, 2.0], 3: [-1e9, 1.0]}
    df = spark.createDataFrame(list(data.items()), "vec_id bigint, embedding array<double>")
    got = topk.topk(df, F.col("id") == 0, scale=1.0, k=3).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 9 * 10**18 + 2 * 10**9), (1, 9 * 10**18 + 10**9), (3, -3 * 10**18 + 10**9)]


# Jaccard join


def shingle_set(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute_groups(rows, k, percent):
    sets = [shingle_set(t, k) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    smallest = {}
    for n, (i, _, _) in enumerate(rows):
        r = find(n)
        smallest[r] = i if smallest.get(r) is None else smallest[r] if i is None else min(i, smallest[r])
    return Counter((i, len(sets[n]), smallest[find(n)]) for n, (i, _, _) in enumerate(rows))


def near_group(n=90, words_each=40, edits=2, seed=5):
    """Many near copies of one text around the limit: some link with each other only through others."""
    rng = random.Random(seed)
    base = [f"w{j}" for j in range(words_each)]
    rows = []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words_each)] = f"x{rng.randrange(30)}"
        rows.append((i + 1, " ".join(copy), "a"))
    return rows


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_jaccard_groups(docs, rows, k, percent):
    got = jaccard.near_duplicates(docs, k, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(rows, k, percent)


@pytest.mark.parametrize("small, tile", [(32, 256), (2, 8)])
def test_jaccard_large_group(spark, monkeypatch, small, tile):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "TILE", tile)
    for k, percent in ((3, 90), (3, 95), (5, 80)):
        rows = near_group()
        got = jaccard.near_duplicates(frame(spark, rows), k, percent).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(rows, k, percent)


def brute_links(rows, k, percent):
    sets = {shingle_set(t, k) for _, t, _ in rows} - {frozenset()}
    n = {a: sum(a != b and 100 * len(a & b) >= percent * len(a | b) for b in sets) for a in sets}
    return Counter((i, n.get(shingle_set(t, k), 0)) for i, t, _ in rows)


@pytest.mark.parametrize("small, tile", [(32, 256), (2, 8)])
def test_jaccard_link_counts(spark, monkeypatch, rows, small, tile):
    """All links between different texts are counted, also those that no component needs."""
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "TILE", tile)
    base = [f"w{j}" for j in range(100)]
    three = [(i, " ".join(base[:-1] + [f"x{i}"]), "a") for i in range(3)]  # each links with both others
    for table, k, percent in ((three, 3, 90), (near_group(), 3, 90), (rows, 5, 80)):
        got = jaccard.near_duplicates(frame(spark, table), k, percent).collect()
        assert Counter((r.doc_id, r.n_links) for r in got) == brute_links(table, k, percent)


def indexed(hashes, ends, percent, order):
    """The segments a set indexes when all sets leave out the last ones in one order, empty ones kept."""
    sent, (own, *spare) = jaccard.segment_hashes(hashes, ends, percent)
    out = []
    for part, n in zip((sent[:own], sent[own:]), spare):
        full = sorted((x for x in part.tolist() if x % 2 == 0), key=order)
        out += full[: len(full) - n] + [x for x in part.tolist() if x % 2]
    return set(out)


def test_segments_meet():
    """Every pair that links indexes a common segment, whatever the order of segments."""
    rng = np.random.default_rng(0)
    orders = [lambda x: x, lambda x: -x, lambda x: (x * 0x9E3779B97F4A7C15) % 2**64]
    for percent in (80, 90):
        ends = jaccard.ranges_up_to(1000, percent)
        for n in (3, 9, 10, 17, 50, 200):
            for _ in range(40):
                a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
                m = int(len(a) * (100 - percent) / 100)
                b = np.unique(np.concatenate([a[m:] if rng.random() < 0.5 else a, rng.integers(0, 2**63, rng.integers(0, m + 1)).astype(np.uint64)]))
                common = len(np.intersect1d(a, b))
                if 100 * common >= percent * (len(a) + len(b) - common) and common < max(len(a), len(b)):
                    for order in orders:
                        assert indexed(a, ends, percent, order) & indexed(b, ends, percent, order)


def test_parities_bound_the_difference():
    rng = np.random.default_rng(5)
    for n in (1, 30, 900, 9000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 2**63, n // 3).astype(np.uint64)]))
        one, two = jaccard.parities(a), jaccard.parities(b)
        longs = min(len(one), len(two))
        unequal = np.unpackbits((jaccard.folded(one, longs) ^ jaccard.folded(two, longs)).view(np.uint8)).sum()
        assert unequal <= len(np.setxor1d(a, b)) and (one == jaccard.parities(a[::-1])).all()
        assert len(one) * 64 >= len(a)


@pytest.mark.parametrize("n", [1023, 1024, 1025, 2100])
def test_parities_of_unlike_sizes(spark, n):
    """Sets next to a doubling of the cells: the columns' count of unequal cells is that of the folded arrays."""
    rng = np.random.default_rng(n)
    a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
    b = np.unique(np.concatenate([a[: n - n // 10], rng.integers(0, 2**63, n // 8).astype(np.uint64)]))
    one, two = jaccard.parities(a), jaccard.parities(b)
    longs = min(len(one), len(two))
    expected = int(np.unpackbits((jaccard.folded(one, longs) ^ jaccard.folded(two, longs)).view(np.uint8)).sum())
    pairs = spark.createDataFrame([(one.tolist(), two.tolist()), (two.tolist(), one.tolist())], "x array<long>, y array<long>")
    assert [r.u for r in pairs.select(jaccard._unequal("x", "y").alias("u")).collect()] == [expected, expected]
    assert expected <= len(np.setxor1d(a, b))
    tile = pd.DataFrame({"cls": [1, 2], "n": [len(a), len(b)], "comp": [1, 2], "side": [0, 0], "bits": [one, two]})
    common = len(np.intersect1d(a, b))
    if 100 * common >= 80 * (len(a) + len(b) - common):
        assert len(jaccard.tile_survivors(tile, 80)) == 2


def test_one_per_group(spark, docs, rows, none):
    kept = jaccard.one_per_group(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in brute_groups(rows, 5, 80)}
    assert {r.doc_id for r in kept.collect()} == want
    assert jaccard.near_duplicates(none).count() == 0


def test_one_per_group_decides_rows(spark):
    """Rows without an id and rows that share an id are kept or dropped by their own text."""
    text = {c: " ".join(f"{c}{j}" for j in range(60)) for c in "abcdefg"}
    near = {c: text[c] + " end" for c in text}
    rows = [
        (1, text["a"], "x"), (None, near["a"], "x"), (None, text["b"], "x"),  # a null id's near copy goes, the clean row stays
        (2, text["c"], "x"), (3, near["c"], "x"), (3, text["d"], "x"),  # of id 3 only the near copy goes
        (4, text["e"], "x"), (4, near["e"], "x"),  # near copies of one id: one stays
        (None, text["f"], "x"), (None, near["f"], "x"),  # likewise without ids
        (None, text["g"], "x"), (None, text["g"], "x"), (None, None, "x"), (5, "", "x"),
    ]
    kept = Counter((r.doc_id, r.text) for r in jaccard.one_per_group(frame(spark, rows)).collect())
    once = {(1, text["a"]), (None, text["b"]), (2, text["c"]), (3, text["d"]), (None, text["g"]), (None, None), (5, "")}
    assert all(n == 1 for n in kept.values()) and once <= set(kept)
    left = set(kept) - once
    assert len(left) == 2 and len(left & {(4, text["e"]), (4, near["e"])}) == 1 and len(left & {(None, text["f"]), (None, near["f"])}) == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (5, 5), (300, 300)]
    got = links.components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()
    assert {(r.node, r.comp) for r in got} == {(i, 0) for i in range(41)} | {(100, 100), (200, 100)}


# line dedup


def test_patience():
    assert line_dedup.patience("abcxde", "abqcde") == [(0, 0), (1, 1), (2, 3), (4, 4), (5, 5)]
    assert line_dedup.patience([], [1]) == []


def line_rows():
    long = [" ".join(f"{c}{j}" for j in range(60)) for c in "abcdef"]
    part = [" ".join(f"{c}{j}" for j in range(20)) for c in "pqrs"]
    return [
        (1, "\n".join(["title one", long[0], "x y", long[1]]), "a"),
        (2, "\n".join(["title two", long[0], "other words here"]), "a"),
        (3, "\n".join(part[:3] + ["end three"]), "a"),
        (4, "\n".join(["start four"] + part[:3] + ["end four"]), "a"),
        (5, "\n".join([part[0], "between", part[1], part[2]]), "a"),
        (6, "\n".join([long[1], long[0]]), "a"),
        (7, long[2], "a"),
        (8, None, "a"),
        (9, "", "a"),
        (10, "\n".join([long[3], long[3], "tail"]), "a"),
        (11, "\n".join([long[3], long[3], "tail eleven"]), "a"),
        (12, long[4], "a"),
        (12, long[4], "a"),
        (None, long[5], "a"),
        (13, long[5] + "\nmine", "a"),
    ]


def test_line_dedup(spark, none):
    data = frame(spark, line_rows())
    out = line_dedup.line_dedup(data)
    assert out.columns == [*data.columns, "deleted_lines"]
    got = defaultdict(set)
    for r in out.collect():
        got[r.doc_id].add(r.text)
    same = {i: t for i, t, _ in line_rows()}
    assert out.count() == len(line_rows())
    for i in (1, 3, 5, 7, 8, 9, 10, 12, None):
        assert got[i] == {same[i]}
    assert got[2] == {"title two\nother words here"} and got[4] == {"start four\nend four"}
    assert got[6] == {""} and got[11] == {"tail eleven"} and got[13] == {"mine"}
    left = line_dedup.without_repeats(data)
    assert left.columns == data.columns and 6 not in {r.doc_id for r in left.collect()} and {8, 9} <= {r.doc_id for r in left.collect()}
    assert line_dedup.line_dedup(none).count() == 0


# quality


def quality_rows(seed=2, n=300):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdef") for _ in range(rng.randint(2, 6))) for _ in range(200)]
    rows, marks = [], []
    for i in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        good = i % 4 != 0
        rows.append((i, " ".join(w).capitalize() + "." if good else " ".join(x.upper() + "!!" for x in w), "a"))
        if i % 3:
            marks.append((i, int(good), 0))
    return rows, marks


def test_quality(spark, none):
    rows, marks = quality_rows()
    data = frame(spark, rows + [(900, None, "a"), (901, "", "a"), (902, rows[1][1], "a"), (902, rows[1][1], "a"), (None, rows[2][1], "a")])
    labels = spark.createDataFrame(marks + [(None, 1, 0), (5000, 1, 0), (1, None, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality(data, labels).collect()}
    good, raw = quality.counts(data, labels)
    table = quality.weights(good, raw)
    for i, t, _ in rows[:40]:
        cells = [c for _, _, part, _ in quality._by_piece([t]) for c in part]
        assert math.isclose(got[i].log_weight, sum(table[c] for c in cells), rel_tol=1e-9, abs_tol=1e-9)
    assert not any(got[i].kept for i in range(0, 300, 4))
    assert sum(got[i].kept for i in range(300)) >= 222  # of 225; noise may swap texts next to the cut
    assert got[900].log_weight == 0 and got[901].log_weight == 0
    kept = quality.good_documents(data, labels)
    assert kept.columns == data.columns and kept.where("doc_id = 902").count() == 2
    assert quality.quality(data, labels.limit(0)).where("kept").count() == data.count()
    assert quality.quality(none, labels).count() == 0


def test_kth_largest(spark):
    rng = random.Random(4)
    values = [rng.gauss(0, 1) ** 5 for _ in range(500)] + [1.0] * 50 + [1.0 + 2**-52]
    df = spark.createDataFrame([(v,) for v in values], "key double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 40, 120, 200, 551):
        assert quality.kth_largest(df, "key", k) == ordered[k - 1]


# toxicity


def test_grammar():
    g = toxicity.Grammar(insults={"scum": 1.0}, stems={"lowe": 0.9}, patterns=dict(toxicity.PRIORS), base=0.01)
    assert g.clause("you scum".split()) == [("target insult", 1.0)]
    assert g.clause("he is not scum".split()) == [("negated insult", 1.0)]
    assert g.clause("anna said scum".split()) == [("reported insult", 1.0)]
    assert g.clause("i will kill you".split()) == [("threat", 0.9)]
    assert g.clause("loweing".split()) == [("insult", 0.9)]
    assert g.score("not. scum") > g.score("not scum") > g.base
    assert g.score(None) == g.score("") == g.base and g.score("Kill the process.") == g.base
    assert g.score("scum! scum!") > g.score("scum!")


def test_toxicity_is_learned(spark, none):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdef") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    rows, marks = [], []
    for i in range(600):
        w = [rng.choice(vocabulary) for _ in range(40)]
        if i % 6 == 0:
            w[7], w[20] = rng.choice(["vorgax", "vorgin", "vorgust"]), rng.choice(["vorgax", "zimp"])
        rows.append((i, " ".join(w), "a"))
        marks.append((i, 1, int(i % 6 == 0)))
    data = frame(spark, rows + [(700, None, "a"), (701, "", "a")])
    labels = spark.createDataFrame(marks + [(None, 1, 1), (1, 1, None)], "doc_id bigint, quality int, toxic int")
    held = suffix_tree.held_out(2, 4)
    got = {r.doc_id: r for r in toxicity.scored(data, labels, held).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(600))
    assert sum(got[i].predicted == (i % 6 == 0) for i in range(600)) >= 594
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.scored(data, flipped, held).collect()}
    assert again == {i: r.score for i, r in got.items()}  # labels of held-out rows are not read
    assert 0 <= got[700].score < 0.3 and got[700].score == got[701].score
    assert toxicity.scored(none, labels, held).count() == 0


# suffix tree


def brute_base(rows, held):
    tokens = {i: WORD.findall((t or "").translate(LOWER)) + [None] for i, t, _ in rows}
    c = Counter()
    for i, t, _ in rows:
        if not held(i):
            c.update(tokens[i])
    n, v = sum(c.values()), len(c)
    return {i: (held(i), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for i, w in tokens.items()}


def test_suffix_tree_root(docs, rows, none):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    want = brute_base(rows, held)
    got = suffix_tree.score(docs, suffix_tree.held_out(0, 10)).collect()
    assert len(got) == len(rows)
    for r in got:
        a = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == a[:4] and math.isclose(r.base_score, a[4], rel_tol=1e-9)
    assert suffix_tree.score(none, suffix_tree.held_out(0, 10)).count() == 0


def test_suffix_tree_learns_contexts(spark, monkeypatch):
    """Sequences that recur are predicted; each state is a distribution; few chunks or many give the same scores."""
    rng = random.Random(8)
    vocabulary = [f"w{j}" for j in range(400)]
    follows = {w: rng.choice(vocabulary) for w in vocabulary}
    rows = []
    for i in range(300):
        w = [rng.choice(vocabulary)]
        for _ in range(40):
            w.append(follows[w[-1]] if rng.random() < 0.7 else rng.choice(vocabulary))
        rows.append((i, " ".join(w), "a"))
    monkeypatch.setattr(suffix_tree, "FREQUENT", 100)  # words with over 1 % of all occurrences are frequent
    data = frame(spark, rows)
    held = suffix_tree.held_out(0, 10)
    got = suffix_tree.score(data, held).collect()
    part = [r for r in got if r.held_out]
    assert sum(r.score for r in part) > 0.75 * sum(r.base_score for r in part)
    monkeypatch.setattr(suffix_tree, "_even_chunks", lambda docs: 7)
    again = {r.doc_id: r.score for r in suffix_tree.score(data, held).collect()}
    assert all(math.isclose(again[r.doc_id], r.score, rel_tol=1e-9) for r in got)


def brute_tree(rows, held):
    """log10 scores with every word as a context, all words being frequent."""
    tokens = {i: WORD.findall((t or "").translate(LOWER)) + [None] for i, t, _ in rows}
    train = [tokens[i] for i, _, _ in rows if not held(i)]
    c = Counter(x for w in train for x in w)
    n, v = sum(c.values()), len(c)
    one, two = {}, {}
    for w in train:
        for j in range(1, len(w)):
            one.setdefault(w[j - 1], Counter())[w[j]] += 1
            if j > 1:
                two.setdefault((w[j - 2], w[j - 1]), Counter())[w[j]] += 1

    def p0(x):
        return (c[x] + 0.1) / (n + 0.1 * (v + 1))

    def smooth(counts, x, parent):
        return (counts[x] + 2 * parent) / (sum(counts.values()) + 2)

    def real(counts, parent):
        size = sum(counts.values())
        return sum(m * math.log((m - 1 + 2 * parent(x)) / ((size + 1) * parent(x))) for x, m in counts.items()) >= 12

    one = {s: k for s, k in one.items() if real(k, p0)}

    def p1(s, x):
        return smooth(one[s], x, p0(x)) if s in one else p0(x)

    two = {s: k for s, k in two.items() if real(k, lambda x: p1(s[1], x))}
    out = {}
    for i, w in tokens.items():
        rates = [p0(w[0])]
        for j in range(1, len(w)):
            q, s = p1(w[j - 1], w[j]), tuple(w[max(0, j - 2) : j])
            rates.append(smooth(two[s], w[j], q) if s in two else q)
        out[i] = sum(map(math.log10, rates))
    return out, len(one), len(two)


@pytest.mark.parametrize("hot", [1.0, 0.0, 1e9])
def test_suffix_tree_frequent_words_are_contexts(spark, monkeypatch, hot):
    """No word is barred from the contexts, and splitting the subtrees of some, all or none gives the same states."""
    rng = random.Random(5)
    vocabulary = [f"w{j}" for j in range(60)]
    follows = {(a, b): rng.choice(vocabulary) for a in vocabulary[:12] for b in vocabulary}
    rows = [(900, None, "a"), (901, "w1", "a"), (902, "w1 unseen w2 w1", "b")]
    for i in range(200):
        w = [rng.choice(vocabulary), "w0"]
        for _ in range(rng.randint(0, 40)):
            w.append(follows[w[-2], w[-1]] if (w[-2], w[-1]) in follows and rng.random() < 0.8 else rng.choice(vocabulary[: rng.choice([5, 60])]))
        rows.append((i, " ".join(w), "a"))
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    want, ones, twos = brute_tree(rows, held)
    assert ones > 1 and twos > 20
    monkeypatch.setattr(suffix_tree, "HOT", hot)
    monkeypatch.setattr(suffix_tree, "_even_chunks", lambda docs: 5)
    got = {r.doc_id: r for r in suffix_tree.score(frame(spark, rows), suffix_tree.held_out(0, 10)).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert math.isclose(r.score, want[i], rel_tol=1e-9)
    assert sum(r.score for r in got.values()) > 0.95 * sum(r.base_score for r in got.values())


# licences


def test_license_rules():
    scan = licenses.scan
    assert scan("x\nLicensed under the Apache License, Version 2.0.\ny")[0] == ["Apache-2.0"]
    assert scan("Released under the MIT License.")[0] == ["MIT"]
    assert scan("This work is licensed under the GNU General Public License, version 3.")[0] == ["GPL-3"]
    assert scan("// Licensed under CC BY-NC 4.0.")[0] == ["CC-BY-NC-4.0"]
    assert scan("# SPDX-License-Identifier: Apache-2.0")[0] == ["APACHE-2.0"]
    assert scan("No license is needed to read this.")[0] == [] and scan(None) == scan("") == ([], [], [])
    text = "Copyright (c) 2011 Somebody\nAll rights reserved.\nAll rights reserved."
    names, matches, loose = scan(text)
    assert names == ["Proprietary"] and len(matches) == 2 and loose == []
    assert text[matches[0][1] : matches[0][2]].startswith("Copyright")
    both = scan("MIT License\n\nCopyright 2020 A\n\nPermission to sing is fine.\nAll rights reserved.")
    assert both[0] == ["MIT", "Proprietary"]


MIT = """MIT License

Copyright (c) 2020 A Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
APACHE = """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// You may obtain a copy of the License at
//
//     http://www.apache.org/licenses/LICENSE-2.0
//
// Unless required by applicable law or agreed to in writing, software
// distributed under the License is distributed on an "AS IS" BASIS,
// WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
// See the License for the specific language governing permissions and
// limitations under the License.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY.
"""


def test_known_sentences_pass_the_filter():
    assert all(licenses._CUE.search(x) and licenses.identify(x) == (name, "") for x, name in licenses.SENTENCES.items())
    wanted = {
        "Distributed under the GNU GPL v3.": "GPL-3", "Released under the GPL version 2.": "GPL-2", "Released under the GPLv3.": "GPL-3",
        "Released under the LGPL v2.1.": "LGPL-2.1", "Licensed under the AGPL v3.": "AGPL-3", "Released under CC BY-SA 4.0.": "CC-BY-SA-4.0",
        "Available under CC-BY 4.0.": "CC-BY-4.0", "Released under CC0 1.0.": "CC-0-1.0", "Under the terms of the Mozilla Public License v2.0": "MPL-2.0",
        "All rights  reserved.": "Proprietary", "This work is dedicated to the public-domain.": "Public-Domain", "SPDX-License-Identifier: ISC": "ISC",
        "Released under Creative-Commons BY 4.0.": "CC-BY-4.0", "Available under the 3-clause BSD license.": "BSD-3",
    }
    assert {x: licenses.scan(x)[0] for x in wanted} == {x: [name] for x, name in wanted.items()}


@pytest.mark.parametrize("text, name", [(MIT, "MIT"), (BSD, "BSD"), (ISC, "ISC"), (APACHE, "Apache-2.0"), (GPL, "GPL-3")])
def test_wrapped_licenses(text, name):
    """The sentences of a wrapped text are joined; one licence covers them and none is left over."""
    names, matches, loose = licenses.scan("Some words\nbefore it.\n\n" + text + "\nand after")
    assert names == [name] and len(matches) == 1 and loose == []
    unwrapped = "\n\n".join(" ".join(x.split()) for x in text.replace("//", "").split("\n\n"))
    assert licenses.scan(unwrapped)[0] == [name]


def test_wrapped_versions():
    assert licenses.scan("It is licensed under the GNU General\nPublic License\nversion 3.")[0] == ["GPL-3"]
    text = "Foo bar\nLicensed under the MIT License.\nSPDX-License-Identifier: Zlib\nother words"
    assert licenses.scan(text) == (["MIT", "ZLIB"], [("MIT", 8, 39), ("ZLIB", 40, 69)], [])


def test_license_query(spark, none):
    rows = [(1, "Released under the MIT License.", "a"), (2, None, "a"), (3, "", "a"), (4, "word " * 50_000 + "\nAll rights reserved.", "a"), (4, "nothing", "a")]
    got = licenses.licenses(frame(spark, rows)).collect()
    assert sorted((r.doc_id, tuple(r.licenses)) for r in got) == [(1, ("MIT",)), (2, ()), (3, ()), (4, ()), (4, ("Proprietary",))]
    assert licenses.licenses(none).count() == 0


# pipeline


def test_pipeline(spark, tmp_path):
    rows, marks = quality_rows(n=200)
    rows += [(500 + i, rows[1][1], "b") for i in range(5)] + [(600, None, None), (601, "", None)]
    folder = str(tmp_path / "tables")
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "mixing", "packing"]
    data = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, data, folder)
        if n < 4:
            assert out.columns == data.columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        data = spark.read.parquet(path)
        seen.append(Counter(r.doc_id for r in data.collect()))
    good = {i for i in range(200) if i % 4 and i in seen[0]}
    assert len(good) >= 147 and not any(i % 4 == 0 for i in range(200) if i in seen[0])  # of 150
    assert not any(500 + i in seen[2] for i in range(5)) and good <= set(seen[2])
    whole = corpus_pipeline.run(spark, folder)
    assert Counter(r.doc_id for r in whole.collect()) == seen[4]
    empty = str(tmp_path / "empty")
    frame(spark, []).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


