"""Token files, importance resampling and phrase collocations against brute force, with nulls, empties, ties, repeats, no rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flowgraph.llm import collocations, resampling, token_files
from flowgraph.plans.sizing import shared_path

SCHEMA = "doc_id bigint, text string, lang string, n_words int, part int, rank string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def texts(seed=3, n=80):
    """(id, text, lang): random texts with marks, accents, odd white space, copies, nulls, a long word and a long text."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    words += ["Don't", "it's", "...", "a.b", "x,y", "!!", "9", "12a", "İstanbul", "é", "क़", "<|endoftext|>", "日本", "\x1c", "a b", "🙂"]
    rows = []
    for i in range(n):
        parts = [rng.choice(words) + rng.choice(["", "", "", ",", ".", "!", "?!"]) for _ in range(rng.randint(0, 60))]
        rows.append((i, rng.choice([" ", "  ", "\n", "\t", "\r\n"]).join(parts), rng.choice(["en", "de", None, "und"])))
    rows += [(n, None, "en"), (n + 1, "", None), (n + 2, " \t\n\x0b", "de"), (n + 3, "Word", "en"), (n + 4, "x" * 3000, "en"), (n + 5, " ".join(words * 60), "de")]
    rows += [(n + 6, rows[4][1], "en"), (n + 6, rows[4][1], "en"), (None, rows[5][1], "de"), (None, rows[6][1], None)]
    rng.shuffle(rows)
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, 5, 6, "x") for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    return texts()


# --- token files ---------------------------------------------------------------------------------------------

@pytest.mark.parametrize("size", [64, 128, 1024])
@pytest.mark.parametrize("share", [0.5, 0.9, 1.0])
def test_blocks_round_trip(size, share):
    rng = np.random.default_rng(size)
    for ids in (
        np.zeros(0, np.uint32), np.zeros(5, np.uint32), np.full(300, 7, np.uint32), rng.integers(0, 2**32, 1000, dtype=np.uint32),
        rng.zipf(1.3, 5000).clip(0, 2**32 - 1).astype(np.uint32), np.array([0, 2**32 - 1] * 200, np.uint32), np.arange(size * 3, dtype=np.uint32),
    ):
        data, lengths = token_files.pack_blocks(ids, size, share)
        assert len(data) == lengths.sum() and len(lengths) == -(-len(ids) // size)
        if len(ids):
            again = token_files.unpack_blocks(data, np.concatenate([[0], np.cumsum(lengths)]), size)
            assert (again[: len(ids)] == ids).all()


def test_outliers_go_to_lists():
    ids = np.full(128, 100, np.uint32)
    ids[::2] += 1
    ids[[5, 77]] = 40_000
    data, lengths = token_files.pack_blocks(ids)
    # one bit each, and two exceptions of a place and the bits above
    assert lengths.tolist() == [8 + 128 // 8 + 2 * 6] and data[4] == 1
    assert (token_files.unpack_blocks(data, np.array([0, len(data)])) == ids).all()


def test_bad_sizes():
    with pytest.raises(ValueError):
        token_files.pack_blocks(np.zeros(1, np.uint32), 100)
    with pytest.raises(ValueError):
        token_files.pack_blocks(np.zeros(1, np.uint32), 128, 0.0)


def test_file_ranges(tmp_path):
    ids = np.random.default_rng(1).zipf(1.4, 700_000).clip(0, 49_000).astype(np.uint32)
    path = str(tmp_path / "a" / "ids.pfb")
    writer = token_files.TokenWriter(path)
    for part in np.array_split(ids, 37):
        writer.add(part)
    writer.close()
    reader = token_files.TokenReader(path)
    assert reader.ids == len(ids)
    for a, b in ((0, 0), (0, 1), (127, 129), (5, 400_000), (0, len(ids)), (len(ids) - 1, len(ids))):
        assert (reader.read(a, b) == ids[a:b]).all()
    with pytest.raises(ValueError):
        reader.read(0, len(ids) + 1)
    (tmp_path / "no").write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        token_files.TokenReader(str(tmp_path / "no"))


@pytest.mark.parametrize("cache", [400_000, 30])
def test_encoder_agrees_with_whole_texts(rows, cache, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE", cache)
    plain = Tokenizer.from_file(VOCABULARY)
    encoder = token_files.Encoder(VOCABULARY)
    for some in (rows[:30], rows[30:60], rows[60:]):
        given = [t or "" for _, t, _ in some]
        ids, counts = encoder.encode(given, 1)
        want = [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in given]
        assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_encoder_keeps_used_pieces(monkeypatch):
    """When there are more pieces than it may remember, those used most stay."""
    monkeypatch.setattr(token_files, "CACHE", 100)
    encoder = token_files.Encoder(VOCABULARY)
    usual = " ".join(["house", "tree,", "x-1"] * 5)
    seen, learn = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new: (seen.extend(new), learn(new)))
    first = encoder.encode([usual], 1)[0]
    for i in range(4):
        encoder.encode([usual + " " + " ".join(f"w{i}v{j}" for j in range(120))], 1)
        assert len(encoder.number) <= 100
    assert seen.count("house") == seen.count("tree,") == seen.count("x-1") == 1
    assert encoder.encode([usual], 1)[0].tolist() == first.tolist()


def test_encoder_without_word_ends(rows):
    encoder = token_files.Encoder(VOCABULARY)
    encoder.ends = None
    given = [t or "" for _, t, _ in rows]
    assert encoder.encode(given, 1)[0].tolist() == token_files.Encoder(VOCABULARY).encode(given, 1)[0].tolist()


def test_token_files(spark, rows):
    folder = shared_path(spark, "tokens")
    index = token_files.write_tokens(table(spark, rows).repartition(5), folder, VOCABULARY)
    plain = Tokenizer.from_file(VOCABULARY)
    got = sorted(token_files.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert len(got) == len(rows) == index.count()
    assert [r.doc_id for r in got] == [None, None, *sorted(i for i, _, _ in rows if i is not None)]
    want = Counter((i, tuple([*plain.encode(t or "", add_special_tokens=False).ids, 1])) for i, t, _ in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids) // 4
        start += r.n_tokens


def test_token_files_of_nothing(spark):
    folder = shared_path(spark, "tokens")
    assert token_files.write_tokens(table(spark, []), folder, VOCABULARY).count() == 0
    assert token_files.read_tokens(spark, folder).count() == 0


# --- importance resampling -----------------------------------------------------------------------------------

def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def resampled(rows, target, percent, least):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s = Counter(bucket(f) for _, t, _ in rows for f in features(t)[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, text, _ in rows:
        n, found = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[2] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1]))
    for place, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = place
    return Counter(map(tuple, out))


@pytest.mark.parametrize("percent", [5, 50, 100, 0])
def test_resampling(spark, rows, percent):
    target = [t for _, t, _ in rows[::9]]
    got = resampling.resample(table(spark, rows).repartition(7), table(spark, [(1, t, "x") for t in target]), percent=percent, least_words=5)
    assert got.columns == ["doc_id", "n_features", "n_words", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == resampled(rows, target, percent, 5)


def test_resampling_of_nothing(spark, rows):
    assert resampling.resample(table(spark, []), table(spark, rows)).count() == 0
    got = resampling.resample(table(spark, rows), table(spark, []), percent=30, least_words=2)
    assert Counter(map(tuple, got.collect())) == resampled(rows, [], 30, 2)


def test_cutoff(spark):
    rng = random.Random(5)
    keys = [(rng.choice([-3, 0, 2, 10**15, rng.randint(-50, 50)]), rng.randint(0, 9), rng.randint(0, 2)) for _ in range(700)]
    keys += [(1, 1, 1)] * 300
    data = spark.createDataFrame(keys, "k0 long, k1 long, k2 long").repartition(9)
    ordered = sorted(keys)
    for k in (1, 2, 17, 350, 500, 999, 1000):
        assert resampling.cutoff(data, k) == ordered[k - 1]
    assert resampling.cutoff(data, 1001) is None and resampling.cutoff(data, 0) is None


def test_weighted_median_discards_a_quarter():
    rng = random.Random(2)
    for _ in range(200):
        parts = [sorted(rng.randint(0, 50) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 12))]
        pivot = resampling.weighted_median([((p[(len(p) - 1) // 2], 0, 0), len(p)) for p in parts])[0]
        everything = [x for p in parts for x in p]
        assert sum(x <= pivot for x in everything) * 4 >= len(everything) <= 4 * sum(x >= pivot for x in everything)


# --- collocations --------------------------------------------------------------------------------------------

def phrases(rows, least, longest, top):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    known = {p: c for p, c in f.items() if len(p) > 2 and c >= least}
    inside = {(p[0], *p[i : i + k]) for p in known for k in range(2, len(p) - 1) for i in range(1, len(p) - k + 1) if known[p] >= f[(p[0], *p[i : i + k])]}
    by_lang = defaultdict(list)
    for p, a in known.items():
        if p in inside:
            continue
        cuts = [(1000 * a * n[p[0]] // (f[p[: k + 1]] * f[(p[0], *p[k + 1 :])]), k) for k in range(1, len(p) - 1)]
        score, k = min(cuts)
        by_lang[p[0]].append((-score, -a, " ".join(p[1:]).encode(), f[p[: k + 1]], f[(p[0], *p[k + 1 :])], len(p) - 1))
    return sorted((lang, rank, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0], x[5]) for lang, found in by_lang.items() for rank, x in enumerate(sorted(found)[:top], 1))


def phrase_rows(seed=4):
    rng = random.Random(seed)
    words = ["new", "york", "city", "the", "of", "Éa", "ñ", "a", "b", "c"]
    out = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts += rng.choice([["New", "York"], ["new", "york", "city", "of", "a"], [rng.choice(words)], ["b", "b"], ["x.y"], [f"w{rng.randint(0, 400)}"]])
        out.append((i, rng.choice([" ", "\t", " \n", "  "]).join(parts) + rng.choice(["", ".", "!"]), rng.choice(["en", "de", None, "und"])))
    return out + [(900, None, "en"), (901, "", None), (902, " . ,", "fr"), (None, "new york city", "en"), (903, "a b " * 3000, "en"), (903, "a b " * 3000, "en")]


@pytest.mark.parametrize("least, longest, top", [(20, 5, 2000), (3, 5, 40), (30, 2, 7), (60, 4, 2000)])
def test_collocations(spark, least, longest, top):
    rows = phrase_rows()
    got = collocations.collocations(table(spark, rows).repartition(6), least, longest, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "words"]
    assert sorted(map(tuple, got.collect())) == phrases(rows, least, longest, top)


def test_collocations_in_small_runs(spark, monkeypatch):
    rows = phrase_rows(7)
    monkeypatch.setattr(collocations, "MOST", 300)
    assert sorted(map(tuple, collocations.collocations(table(spark, rows), 15).collect())) == phrases(rows, 15, 5, 2000)


def test_collocation_ranges_follow_the_words(spark, monkeypatch):
    """What meets in one range does not grow with the input: ranges are added with the words, and the phrases stay the same."""
    rows = phrase_rows()
    monkeypatch.setattr(collocations, "RANGE_WORDS", 64)
    known, _, ranges = collocations.frequent(table(spark, rows), 5, 15)
    assert ranges == -(-known.where("word is null").agg({"n": "sum"}).first()[0] // 64) > 64
    assert sorted(map(tuple, collocations.collocations(table(spark, rows), 15).collect())) == phrases(rows, 15, 5, 2000)


def test_union_holds_few_transducers(monkeypatch):
    """Transducers are taken one after the other, and equal paths are summed before all have come."""
    rng = np.random.default_rng(5)
    paths, weights = collocations.summed(rng.integers(0, 9, (300, 3)).astype(np.uint64), np.ones(300, np.int64))
    monkeypatch.setattr(collocations, "MOST", len(paths))
    sizes, joined = [], collocations._joined
    monkeypatch.setattr(collocations, "_joined", lambda held: sizes.append(sum(len(p) for p, _ in held)) or joined(held))
    part = collocations.Transducer.of(paths, weights)
    p, w = collocations.union(part for _ in range(40))
    assert dict(zip(map(tuple, p), w)) == {tuple(x): 40 * n for x, n in zip(paths, weights)}
    assert max(sizes) <= 3 * len(paths)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(table(spark, [])).count() == 0
    assert collocations.collocations(table(spark, [(1, None, None), (2, "one two", "en")])).count() == 0


def test_large_products_are_exact(spark):
    a, n, l, r = 99_999_999_999, 99_999_999_999_999, 99_999_999_977, 88_888_888_888
    row = spark.sql(f"select cast({1000 * a} as decimal(19,0)) * cast({n} as decimal(18,0)) div (cast({l} as decimal(18,0)) * cast({r} as decimal(18,0))) as x").first()
    assert row.x == 1000 * a * n // (l * r) and 1000 * a * n > 2**64


def test_transducers():
    rng = np.random.default_rng(3)
    for length, n in ((1, 20), (3, 400), (6, 2000)):
        paths = np.unique(rng.integers(0, 9, (n, length)).astype(np.uint64) * np.uint64(2**60), axis=0)
        weights = rng.integers(1, 4, len(paths))
        t = collocations.Transducer.of(paths, weights)
        again = collocations.Transducer.from_bytes(t.to_bytes())
        for x in (t, again):
            p, w = x.paths()
            assert (p == paths).all() and (w == weights).all()
        asked = np.unique(np.concatenate([paths[::3], rng.integers(0, 12, (50, length)).astype(np.uint64) * np.uint64(2**60)]), axis=0)
        known = {tuple(p): w for p, w in zip(paths.tolist(), weights.tolist())}
        found = collocations.Transducer.of(asked, np.zeros(len(asked), np.int64)).compose(again)
        assert found.tolist() == [known.get(tuple(p), 0) for p in asked.tolist()]
        p, w = collocations.union([t, again, collocations.Transducer.of(asked, np.ones(len(asked), np.int64))])
        both = Counter(known) + Counter(known) + Counter({tuple(x): 1 for x in asked.tolist()})
        assert {tuple(x): y for x, y in zip(p.tolist(), w.tolist())} == both


def test_transducers_share_states():
    # every suffix of every prefix is alike: one state per depth
    paths = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)], np.uint64)
    t = collocations.Transducer.of(paths, np.full(len(paths), 5, np.int64))
    assert [len(a) for _, a, _ in t.arcs] == [8, 8, 8]
    empty = collocations.Transducer.of(np.zeros((0, 3), np.uint64), np.zeros(0, np.int64))
    assert len(empty.paths()[0]) == 0 and t.compose(empty).sum() == 0 and len(empty.compose(t)) == 0
