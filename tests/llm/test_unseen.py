"""Scores do not depend on how the rows are dealt, and texts the models were not fitted on are treated alike."""

import random
import zlib

from test_llm import frame

from flowgraph.llm import quality, suffix_tree


def prose(seed, n):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdef") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    return [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 90))), "a") for i in range(n)]


def test_suffix_tree_scores_shuffled_rows_alike(spark, tmp_path):
    rows = prose(1, 240)
    path = str(tmp_path / "docs")
    frame(spark, rows).write.parquet(path)
    files = spark.read.parquet(path)
    held = suffix_tree.held_out(0, 10)
    want = {r.doc_id: (r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in suffix_tree.score(files, held).collect()}
    assert len(want) == 240
    for data in (files.repartition(4), files.repartition(9, "doc_id"), files.coalesce(1), files.where("doc_id < 120").unionByName(files.where("doc_id >= 120").repartition(3))):
        got = {r.doc_id: (r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in suffix_tree.score(data, held).collect()}
        assert got == want


def test_quality_keeps_good_texts_it_was_not_fitted_on(spark):
    rng = random.Random(9)
    rows, marks = [], []
    for i, text, source in prose(2, 300):
        text += " end of it"
        good = i % 3 != 0
        rows.append((i, text.capitalize() + "." if good else " ".join(w + "$$$" for w in text.upper().split()), source))
        if zlib.crc32(str(i).encode()) % 2:
            marks.append((i, int(good), 0))
    rng.shuffle(rows)
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id for r in quality.good_documents(frame(spark, rows), labels).select("doc_id").collect()}
    labelled = {i for i, _, _ in marks}
    unseen = [i for i in range(300) if i % 3 and i not in labelled]
    assert len(unseen) > 80 and sum(i in kept for i in unseen) >= 0.98 * len(unseen)
    assert sum(i in kept for i in range(0, 300, 3)) <= 2
