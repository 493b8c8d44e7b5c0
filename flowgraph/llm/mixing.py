"""Mixing sources to target weights by Pareto order sampling; DataFrame functions only.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and share `total` times all words; a target stops
at `cap` times its source's words and the excess is shared again by weight until none is above. Every document takes
floor(target / words of its source) certain whole copies. The rest of the target is drawn without replacement: document i
with inclusion probability p_i has the rank (u_i / (1 - u_i)) / (p_i / (1 - p_i)), u_i uniform from a hash of seed and id, and
a source takes its documents in the order of rank while their words fit the rest; what is left open then is filled in the
same order with documents that fit it.

p_i = min(1, c m_i) with the `measure` m_i, by default the whole part of the root of the document's words: longer documents are likelier,
less than in proportion. Each source has its own c, solved so that the expected words, the sum of p_i times words, are the rest;
documents with p_i = 1 come before all others. c comes from the words per (source, measure): a table with a row for
each different measure, some hundred for the default.

Nothing is sorted whole: ranks are cut into bins of some thousand documents, words are summed per (source, bin), and
the running sum inside a bin starts from the sum of the bins before it. A source with a third of all rows is spread over bins.

Defined cases: a null text has size 0; documents without words are taken 0 times; a null source is a source of its own; rows
that repeat id, source and size share one decision; a null id ranks like the text 'null'; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgraph.llm.common import apart, stored, words_in

WEIGHTS = (5, 2, 1)
BIN_ROWS = 2_000
SALTS = 16


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: k (its place), source_size, target. 150 % in all, at most twice a source's size."""
    big = "decimal(18,0)"
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).cast("long").alias("source_size")).withColumn(
        "k", F.row_number().over(order)
    )
    weighed = place.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("k") - 1, F.lit(len(WEIGHTS))) + 1).cast("int")).cast("long"))
    # Sources whose cap is small for their weight reach it first. Before the one at hand, `capped` words are given away and
    # `weights` still share the rest: the source is capped when its share of that rest, (3 S - 2 capped) / 2, is above its cap.
    ratio = Window.orderBy((F.col("source_size") * 2.0 / F.col("weight")).asc(), F.col("k"))
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    run = (
        weighed.withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("capped", F.coalesce(F.sum(F.col("source_size") * 2).over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("full", (F.col("source_size") * 4).cast(big) * F.col("weights").cast(big)
                    < (F.col("all_words") * 3 - F.col("capped") * 2).cast(big) * F.col("weight").cast(big))
    )
    rest = run.withColumn("given", F.coalesce(F.sum(F.when(F.col("full"), F.col("source_size") * 2)).over(everything), F.lit(0))).withColumn(
        "sharing", F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    )
    share = (F.col("all_words") * 3 - F.col("given") * 2).cast("double") * F.col("weight") / (F.col("sharing") * 2).cast("double")
    return rest.select(
        "source", "k", "source_size",
        F.when(F.col("full"), F.col("source_size") * 2.0).otherwise(F.least(F.col("source_size") * 2.0, share)).alias("target"),
    )


def _uniform(seed: str) -> Column:
    """In (0, 1), from the first 13 hex digits of a digest of seed and id."""
    name = F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def chances(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """Add to each source: certain (whole copies of everything), room (words left to draw), per_measure (c) and least, the
    smallest measure that is sure to be drawn (null: none).

    Documents of measure m are sure when all larger ones whole and the others in proportion to their measure, up to 1 at m, need
    no more than the room.
    """
    certain = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("certain", certain).withColumn("room", F.col("target") - F.col("certain") * F.col("source_size"))
    words = sizes.where("size > 0 and measure > 0").groupBy("source", "measure").agg(F.sum(F.col("size") * F.col("rows")).cast("double").alias("words"))
    rooms = goals.select(F.col("source").alias("of"), "k", "room")
    each = words.join(rooms, F.col("source").eqNullSafe(F.col("of"))).select("k", "room", "measure", "words")
    larger = Window.partitionBy("k").orderBy(F.col("measure").desc()).rowsBetween(Window.unboundedPreceding, -1)
    others = Window.partitionBy("k").orderBy(F.col("measure").desc()).rowsBetween(0, Window.unboundedFollowing)
    above = F.coalesce(F.sum("words").over(larger), F.lit(0.0))
    sure = F.sum(F.col("words") * F.col("measure")).over(others) <= (F.col("room") - above) * F.col("measure")
    solved = each.withColumn("sure", sure).groupBy(F.col("k").alias("place")).agg(
        F.coalesce(F.sum(F.when(F.col("sure"), F.col("words"))), F.lit(0.0)).alias("given"),
        F.sum(F.when(~F.col("sure"), F.col("words") * F.col("measure"))).alias("rest"),
        F.min(F.when(F.col("sure"), F.col("measure"))).alias("least"),
    )
    return goals.join(solved, F.col("k") == F.col("place"), "left").select(
        *goals.columns, ((F.col("room") - F.col("given")) / F.col("rest")).alias("per_measure"), "least"
    )


def _drawn(rows: DataFrame, room: str, nearest: bool) -> DataFrame:
    """Add `picked`: rows in the order of rank, per source k, while their words fit `room`."""
    bins = rows.groupBy("k", "bin").agg(F.sum("words").alias("in_bin"))
    earlier = Window.partitionBy("k").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bins.select("k", "bin", F.coalesce(F.sum("in_bin").over(earlier), F.lit(0)).alias("offset"))
    order = Window.partitionBy("k", "bin").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(offsets, ["k", "bin"]).withColumn("sum", F.col("offset") + F.sum("words").over(order))
    fits = F.col("sum") * 2 - F.col("words") <= F.col(room) * 2 if nearest else F.col("sum") <= F.col(room)
    return summed.withColumn("picked", fits & (F.col("words") > 0)).drop("offset", "sum")


def mix(docs: DataFrame, seed: str = "mix-1:", measure: Column | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row per document (rows repeated whole: one each)."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words_in().alias("size"),
                       (F.lit(None) if measure is None else measure).cast("double").alias("measure"))
    usual_measure = F.floor(F.sqrt(F.col("size").cast("double"))).cast("double")
    # `rows` rows that agree in id, source and size stand together: they are drawn as one.
    sizes = stored(
        read.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"), F.max(F.coalesce("measure", usual_measure)).alias("measure")), "sizes"
    )
    n = sizes.count()
    bins = max(1, -(-n // BIN_ROWS))
    goals = stored(chances(sizes, targets(sizes)), "targets")
    spread = goals.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    salted = sizes.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    same = (salted["salt"] == spread["salt"]) & salted["source"].eqNullSafe(spread["source"])
    columns = ["size", "rows", "measure", "k", "source_size", "target", "certain", "room", "per_measure", "least"]
    rows = salted.join(spread, same).select(sizes["doc_id"], sizes["source"], *columns)
    # All odds of a source are scaled by one factor, which keeps their order and spreads the ranks over (0, 1).
    usual = F.col("room") / F.col("source_size").cast("double")
    odds = (F.col("u") / (1 - F.col("u"))) * ((usual / (1 - usual)) / (F.col("chance") / (1 - F.col("chance"))))
    ranked = (
        rows.withColumn("words", F.col("size") * F.col("rows"))
        .withColumn("u", _uniform(seed))
        .withColumn("chance", F.when(F.col("measure") >= F.col("least"), 1.0).otherwise(F.coalesce(F.col("per_measure") * F.col("measure"), F.lit(0.0))))
        # odds / (1 + odds) orders as odds does and lies in [0, 1), which makes bins; sure documents have bins below, impossible ones above
        .withColumn("rank", F.when(F.col("chance") >= 1, F.col("u") - 1).when(F.col("chance") <= 0, F.col("u") + 1).otherwise(odds / (1 + odds)))
        .withColumn("bin", F.floor(F.col("rank") * bins).cast("long"))
        .select("doc_id", "source", "k", "size", "rows", "words", "source_size", "target", "certain", "room", "rank", "bin")
    )
    first = stored(_drawn(ranked, "room", nearest=False), "drawn")
    open_room = first.groupBy("k").agg((F.max("room") - F.coalesce(F.sum(F.when(F.col("picked"), F.col("words"))), F.lit(0))).alias("gap"))
    gaps = open_room.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    left = first.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).join(gaps, ["k", "salt"]).drop("salt")
    small = ~F.col("picked") & (F.col("words") <= F.col("gap") * 2)
    second = _drawn(left.where(small).drop("picked"), "gap", nearest=True)
    decided = left.where(~small).drop("gap").unionByName(second.drop("gap").select(*first.columns))
    copies = F.col("certain") + F.col("picked").cast("long")
    return decided.select(
        "doc_id", "source", "size", "source_size", "target", F.when(F.col("size") > 0, copies).otherwise(0).cast("long").alias("copies"), "rows"
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, copies, taken."""
    each = mix(docs.select("doc_id", "source", "text")).withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of docs, each as often as the mix takes it."""
    given = apart(docs, "doc_id", "source", "text")
    decided = mix(given).where("copies > 0").select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("copies").alias("_copies"))
    sized = given.withColumn("_words", words_in())
    same = sized["doc_id"].cast("long").eqNullSafe(decided["_id"]) & sized["source"].eqNullSafe(decided["_source"]) & (sized["_words"] == decided["_size"])
    copied = sized.join(decided, same).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return copied.select(*given.columns).toDF(*docs.columns)


ORACLE = r"""
with recursive s as materialized (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents),
src as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as k from s group by source),
w as (select *, [5, 2, 1][((k - 1) % 3) + 1] as weight from src),
run as (select *, sum(source_size) over () as all_words,
  coalesce(sum(source_size * 2) over (order by source_size * 2.0 / weight, k rows between unbounded preceding and 1 preceding), 0) as capped,
  sum(weight) over () - coalesce(sum(weight) over (order by source_size * 2.0 / weight, k rows between unbounded preceding and 1 preceding), 0) as weights
  from w),
f as (select *, source_size * 4 * weights < (all_words * 3 - capped * 2) * weight as isfull from run),
g as (select *, coalesce(sum(case when isfull then source_size * 2 end) over (), 0) as given, sum(case when not isfull then weight end) over () as sharing from f),
t as (select source, k, source_size, case when isfull then source_size * 2::double
  else least(source_size * 2::double, cast(all_words * 3 - given * 2 as double) * weight::double / cast(sharing * 2 as double)) end as target from g),
r as (select s.doc_id, s.size, t.*, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as certain,
  (cast(('0x' || substr(md5('mix-1:' || s.doc_id), 1, 13)) as bigint)::double + 0.5) / 4503599627370496::double as u
  from s join t on s.source is not distinct from t.source),
r2 as (select *, target - certain * source_size as room from r),
m as (select k, any_value(room) as room, floor(sqrt(size::double)) as measure, sum(size)::double as words from r2 where size > 0 group by k, floor(sqrt(size::double))),
m2 as (select *, sum(words * measure) over (partition by k order by measure) <=
  (room - coalesce(sum(words) over (partition by k order by measure desc rows between unbounded preceding and 1 preceding), 0)) * measure as sure from m),
c as (select k as place, (any_value(room) - coalesce(sum(words) filter (sure), 0)) / sum(words * measure) filter (not sure) as per_measure,
  min(measure) filter (sure) as least from m2 group by k),
r3 as (select r2.*, room / source_size::double as usual, case when floor(sqrt(size::double)) >= least then 1
  else coalesce(per_measure * floor(sqrt(size::double)), 0) end as chance from r2 left join c on c.place = r2.k),
o as (select *, case when chance > 0 and chance < 1 then (u / (1 - u)) * ((usual / (1 - usual)) / (chance / (1 - chance))) end as odds from r3),
r4 as (select *, case when chance >= 1 then u - 1 when chance <= 0 then u + 1 else odds / (1 + odds) end as rank from o),
p1 as (select *, size > 0 and sum(size) over (partition by k order by rank, doc_id rows unbounded preceding) <= room as one from r4),
gap as (select *, room - coalesce(sum(case when one then size end) over (partition by k), 0) as gap from p1),
p2 as (select *, not one and size <= gap * 2 as small from gap),
p3 as (select *, small and size > 0 and sum(case when small then size end) over (partition by k, small order by rank, doc_id rows unbounded preceding) * 2 - size <= gap * 2 as two from p2)
select doc_id, source, size, source_size, target, case when size > 0 then certain + case when one or two then 1 else 0 end else 0 end as copies,
  (certain + case when one or two then 1 else 0 end) * size as taken from p3
"""
