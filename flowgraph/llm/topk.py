"""Exact top-k search by tiled matrix products.

Queries and candidates are dealt by hashes of their ids into blocks of bounded size; each pair of a query block and a shard
is a tile, handled as one group: its matrix product, then each query's k best of the shard. The partial lists of a query are
merged as a tree: `FAN` shards at a time, then all. A tile holds about `block` queries and `shard` candidates whatever the
size of the tables. The query set is a fixed share of the rows, so this is the stated set against all rows, in blocks.

Numbers: a component x counts as floor(256 x). Products run in double precision while every possible score of the tile is
below 2**53, and are then exact; beyond, in Python integers, cut to the range of long.

Defined cases: a vector that is null, empty or holds a null or non-finite component takes no part, nor does a null id; of the
rows that repeat an id the smallest vector counts; vectors only meet vectors of their own length; fewer than k candidates
give shorter lists; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024
SHARD = 8192
FAN = 32
STRIP = 256


def usable(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """id, v (array of whole doubles), dim: one row per id."""
    numbers = F.col(vector).cast("array<double>")
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.where(F.col(key).isNotNull() & (F.size(F.col(vector)) > 0) & finite)
    scaled = kept.select(F.col(key).cast("long").alias("id"), numbers.alias("x"))
    one = scaled.groupBy("id").agg(F.min("x").alias("x"))
    return one.select("id", F.transform("x", lambda x: x * F.lit(scale)).alias("v"), F.size("x").alias("dim"))


def _matrix(frame: pd.DataFrame, key: str, vector: str) -> tuple[np.ndarray, np.ndarray]:
    frame = frame.sort_values(key)
    return frame[key].to_numpy(np.int64), np.floor(np.stack(frame[vector].to_numpy()).astype(np.float64))


def best_of_tile(query_ids, queries, ids, candidates, k: int):
    """(query_id, id, score) arrays of each query's k best; ids ascending, so that a smaller place wins ties."""
    bound = np.abs(queries).max() * np.abs(candidates).max() * queries.shape[1]
    exact = bound * 2 * (len(ids) + 1) < 2**53
    found = []
    for a in range(0, len(query_ids), STRIP):
        strip = queries[a : a + STRIP]
        if exact:
            # score and place in one number: larger is better
            key = (strip @ candidates.T) * len(ids) - np.arange(len(ids))
            own = np.searchsorted(ids, query_ids[a : a + STRIP])
            own_row = np.flatnonzero((own < len(ids)) & (ids[np.minimum(own, len(ids) - 1)] == query_ids[a : a + STRIP]))
            key[own_row, own[own_row]] = -np.inf
            take = min(k, len(ids))
            places = np.argpartition(-key, take - 1, axis=1)[:, :take]
            values = np.take_along_axis(key, places, axis=1)
            rows, cols = np.nonzero(values > -np.inf)
            place = places[rows, cols]
            score = ((values[rows, cols] + place) / len(ids)).round().astype(np.int64)
            found.append((query_ids[a + rows], ids[place], score))
            continue
        whole = [[int(x) for x in row] for row in candidates]
        for row, one in enumerate(strip):
            left = [int(x) for x in one]
            scores = [max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(left, right)))) for right in whole]
            order = [i for i in sorted(range(len(ids)), key=lambda i: (-scores[i], i)) if ids[i] != query_ids[a + row]][:k]
            found.append((np.full(len(order), query_ids[a + row]), ids[order], np.array([scores[i] for i in order], np.int64)))
    return tuple(np.concatenate(part) for part in zip(*found))


def topk(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: float = 256.0,
         block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the k other vectors with the highest integer inner product. `is_query` reads column id."""
    rows = usable(vectors, key, vector, scale)
    counts = rows.select(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    shards, blocks = max(1, -(-counts.n // shard)), max(1, -(-counts.q // block))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.withColumn("s", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).withColumn("b", all_of(blocks))
    asked = rows.where(is_query).select(F.col("id").alias("query"), F.col("v").alias("w"), F.col("dim").alias("query_dim"))
    queries = asked.withColumn("query_b", F.pmod(F.xxhash64("query", F.lit("b")), F.lit(blocks)).cast("int")).withColumn("query_s", all_of(shards))

    def tile(key_values, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "s": [], "vec_id": [], "score": []}).astype("int64")
        query_ids, q = _matrix(left, "query", "w")
        ids, c = _matrix(right, "id", "v")
        who, whom, score = best_of_tile(query_ids, q, ids, c, k)
        return pd.DataFrame({"query_id": who, "s": np.int64(key_values[0]), "vec_id": whom, "score": score})

    tiles = queries.groupBy("query_s", "query_b", "query_dim").cogroup(candidates.groupBy("s", "b", "dim"))
    partial = tiles.applyInPandas(tile, "query_id long, s long, vec_id long, score long")
    for keys in (["query_id", F.floor(F.col("s") / FAN)], ["query_id"]):
        best = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
        partial = partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return partial.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
with v as (select vec_id, min(embedding) as e from embeddings
  where vec_id is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0 group by vec_id),
w as (select vec_id, [floor(256 * x::double) for x in e] as e from v),
s as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from w q join w c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 5
"""
