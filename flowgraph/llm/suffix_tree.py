"""Language-model scores by a probabilistic suffix tree over words.

Tokens: words [^\\x20\\x09-\\x0D]+ of the text with A-Z in lower case, then one end. The root is the unigram model
p(x) = (c + 0.1) / (N + 0.1 (V + 1)). A state is a context of one or two preceding words. Its next-word distribution is smoothed
by that of its parent, (n(s, x) + MU p(x | parent)) / (n(s) + MU), so every state is a distribution over all words. A state is
retained when its divergence from its parent is real: the log likelihood it gains over the parent on its own training words,
each left out of the counts in turn, must reach GAIN nats. A word is scored by the longest retained suffix of what precedes it.

Every word may be a context. In the test a parent's probability for a word that is not among the frequent ones (more than
N / FREQUENT occurrences, so at most FREQUENT words) counts as 1 / FREQUENT, its upper bound.

How it runs. Documents are handled in chunks (the part of a file that one task reads, split by a hash of the id), whose size does
not grow with the table. A chunk sends its different words, and its different (word before that, word before, word), each
with the number of training occurrences, as one packed row per bucket of the word, or of the word before. A bucket sums the
counts of all chunks, decides on its states and answers each chunk's rows in their order. So words cross the network once per
chunk rather than once per occurrence, and the model is never in one place. The number of buckets grows with the number of
chunks. What is gathered covers all training documents.

A bucket holds the whole subtree of a word, unless the word has more than HOT times an average bucket's occurrences. The
subtree of such a word is dealt over slices by a hash of (word before, word). A state's gain is a sum over its next words and a term
of its size, so slices send their part of it: per word before (few, summed by Spark) and per state of two words, packed, to a
bucket of the state. Both answer which states are retained, with their sizes. The states and scores are those of a whole subtree.

Defined cases: a null or empty text is the end alone; a null id belongs to the training documents; rows that repeat id and
text are scored one by one; without training documents all words have c = 0; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgraph.llm import words
from flowgraph.llm.common import stored

FREQUENT = 1 << 16
MU = 2.0
GAIN = 12.0
HOT = 1.0
SLICES = 4  # buckets of contexts, and slices of hot words, for each bucket of words
END = np.uint64(0x5EED0FE2D0000001)
CHUNK_MB = 8


def held_out(remainder: int, modulus: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def _chunked(docs: DataFrame, held: Column) -> DataFrame:
    """doc_id, text, train, chunk: the same chunk for a row in every pass, and all rows of a chunk in one task.

    Rows that come straight from files stay in the part of the file they are read from. Others (after a shuffle) have no such
    place: they are dealt by a hash of id and text, which shuffles the texts once per pass.
    """
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (~held).alias("train"))
    if docs.select(F.input_file_name().alias("name")).where("name = ''").isEmpty():
        split = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
        small = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, split // (CHUNK_MB << 20))))
        return read.withColumn("chunk", F.xxhash64(F.input_file_name(), F.input_file_block_start(), small))
    return read.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(_even_chunks(docs)))).repartition("chunk")


def _even_chunks(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // (CHUNK_MB << 20)))


def _tokens(texts) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of the texts and the text each belongs to."""
    found, owners, done = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], 0
    for a, b, hashes, counts in words.word_hashes(texts):
        found.append(np.insert(hashes, counts[1:], END))
        owners.append(np.repeat(np.arange(done, done + b - a, dtype=np.int32), np.diff(counts) + 1))
        done += b - a
    tokens = np.concatenate(found)
    del found
    return tokens, np.concatenate(owners)


def _runs(major: np.ndarray, minor: np.ndarray):
    """Order of rows by (major, minor), and a mark where a row in that order differs from the one before."""
    order = np.lexsort((minor, major))
    new = np.ones(len(order), bool)
    ordered = major[order]
    new[1:] = ordered[1:] != ordered[:-1]
    ordered = minor[order]
    new[1:] |= ordered[1:] != ordered[:-1]
    return order, new


def _grouped(major: np.ndarray, minor: np.ndarray):
    """Order of rows by (major, minor), starts of equal rows in that order, and each row's group."""
    order, new = _runs(major, minor)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), group


def _word_rows(tokens: np.ndarray, buckets: int):
    return (tokens % np.uint64(buckets)).astype(np.uint64), tokens


def _context_rows(tokens: np.ndarray, owners: np.ndarray, frequent: np.ndarray, hot: np.ndarray, buckets: int):
    """Positions with a context, and for each its bucket and word before (major), the word before that and the word (minor).

    Those after a hot word come last: their major is a slice (a bucket from `buckets` on) and the word, their minor the place of
    the word before and the word before that.
    """
    place = np.minimum(np.searchsorted(frequent, tokens), max(0, len(frequent) - 1))
    often = frequent[place] == tokens if len(frequent) else np.zeros(len(tokens), bool)
    place = place.astype(np.uint32)
    code = np.where(often, place, (np.uint64(FREQUENT) + (tokens >> np.uint64(20)) % np.uint64(2**32 - FREQUENT)).astype(np.uint32))
    at = np.arange(1, len(tokens), dtype=np.int32)
    at = at[owners[1:] == owners[:-1]]
    dealt = often[at - 1] & hot[place[at - 1]] if len(frequent) else np.zeros(len(at), bool)

    def second(at: np.ndarray, shift: int) -> np.ndarray:
        earlier = tokens[at - 2]
        earlier >>= np.uint64(shift)
        earlier |= np.uint64(1)
        earlier[(at < 2) | (owners[at - 2] != owners[at])] = 0
        return earlier

    whole, split = at[~dealt], at[dealt]
    at = np.concatenate([whole, split])
    del often, dealt
    major, minor = np.empty((2, len(whole) + len(split)), np.uint64)
    n = len(whole)
    before = tokens[whole - 1]
    major[:n] = ((before % np.uint64(buckets)) << np.uint64(32)) | (words.mix(before) >> np.uint64(32))
    minor[:n] = (second(whole, 32) << np.uint64(32)) | code[whole]
    part = words.mix(words.mix(tokens[split - 1]) + tokens[split]) % np.uint64(buckets)
    major[n:] = ((np.uint64(buckets) + part) << np.uint64(32)) | code[split]
    minor[n:] = (place[split - 1].astype(np.uint64) << np.uint64(48)) | second(split, 16)
    return at, major, minor


def _columns(table: pa.Table):
    return table["text"].combine_chunks(), table["train"].to_numpy()


def _by_chunk(batches):
    """(chunk, texts, train) for every chunk in a task's rows."""
    found: dict[int, list] = {}
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for chunk in np.unique(table["chunk"].to_numpy()):
            found.setdefault(int(chunk), []).append(table.filter(pa.compute.equal(table["chunk"], int(chunk))))
        del batch, table
    while found:
        chunk = next(iter(found))
        # nothing here keeps a chunk's texts while it is worked on
        yield chunk, *_columns(pa.concat_tables(found.pop(chunk)))


def _packed_docs(batches):
    """The rows of a chunk in each batch as one compressed row."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for chunk in np.unique(table["chunk"].to_numpy()):
            own, sink = table.filter(pa.compute.equal(table["chunk"], int(chunk))).select(["doc_id", "text", "train"]), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(own)
            yield pa.RecordBatch.from_arrays([pa.array([int(chunk)]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "docs"])


def _sent(chunk: int, major, minor, train, bucket_of, pack):
    """One packed row per bucket: the different (major, minor) and their training counts."""
    order, new = _runs(major, minor)
    if not len(order):
        return None
    starts = np.flatnonzero(new)
    counts = np.add.reduceat(train[order], starts, dtype=np.uint32)
    major, minor = major[order[starts]], minor[order[starts]]
    bucket = bucket_of(major)
    cut = np.concatenate([np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), [len(bucket)]])
    rows = [(chunk, int(bucket[a]), pack(major[a:b], minor[a:b]), zlib.compress(counts[a:b].tobytes(), 1), int(counts[a:b].sum())) for a, b in zip(cut[:-1], cut[1:])]
    columns = list(zip(*rows))
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["chunk", "bucket", "items", "counts", "total"])


_SENT = "chunk long, bucket long, items binary, counts binary, total long"


def _counts(column) -> list[np.ndarray]:
    return [np.frombuffer(zlib.decompress(x), np.uint32) for x in column]


def _sum_words(frame: pd.DataFrame, limit: float) -> pd.DataFrame:
    """For each chunk its words' counts over all chunks; the bucket's frequent words and number of different words."""
    items = [np.frombuffer(x, np.uint64) for x in frame["items"]]
    values, group = np.unique(np.concatenate(items), return_inverse=True)
    total = np.bincount(group, weights=np.concatenate(_counts(frame["counts"])), minlength=len(values)).astype(np.int64)
    ends = np.cumsum([len(x) for x in items])
    answers = [zlib.compress(part.astype(np.uint64).tobytes(), 1) for part in np.split(total[group], ends[:-1])]
    often = total > limit
    out = pd.DataFrame({"chunk": frame["chunk"], "bucket": frame["bucket"], "answer": answers, "kind": 0, "different": 0})
    mark = np.concatenate([values[often], total[often].astype(np.uint64)]).tobytes()
    more = pd.DataFrame({"chunk": [0], "bucket": frame["bucket"][:1], "answer": [mark], "kind": [1], "different": [int((total > 0).sum())]})
    return pd.concat([out, more])


def _part(n, parent):
    """A word's part in the gain of a state, which does not depend on the state's size."""
    return np.where(n > 0, n * np.log((np.maximum(n - 1, 0) + MU * parent) / parent), 0.0)


def _gain(parts, size):
    """Log likelihood gained over the parent, each occurrence left out of the counts in turn."""
    return parts - size * np.log(np.maximum(size - 1, 0) + MU)


def _rates(code: np.ndarray, usual: np.ndarray) -> np.ndarray:
    return np.where(code < FREQUENT, usual[np.minimum(code, len(usual) - 1).astype(np.int64)], 1.0 / FREQUENT)


def _states(frame: pd.DataFrame, usual: np.ndarray) -> pd.DataFrame:
    """For each chunk's rows n and size of the states of one and two words (size 0: not retained)."""
    packed = [np.frombuffer(x, np.uint32) for x in frame["items"]]
    lengths = [len(x) // 3 for x in packed]
    before = np.concatenate([x[:m] for x, m in zip(packed, lengths)]).astype(np.uint64)
    second = np.concatenate([x[m : 2 * m] for x, m in zip(packed, lengths)])
    code = np.concatenate([x[2 * m :] for x, m in zip(packed, lengths)])
    counts = np.concatenate(_counts(frame["counts"])).astype(np.float64)
    p = _rates(code, usual)

    def level(state, parent_of_row):
        """n and size of each row's state, 0 where the state is not retained."""
        order, starts, group = _grouped(state, code)
        n = np.add.reduceat(counts[order], starts)
        heads = order[starts]
        state_of, parent = state[heads], parent_of_row[heads]
        first = np.flatnonzero(np.concatenate([[True], state_of[1:] != state_of[:-1]]))
        per = np.add.reduceat(n, first)
        which = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(n)]])))
        kept = _gain(np.add.reduceat(_part(n, parent), first), per) >= GAIN
        return n[group], (per * kept)[which][group]

    n1, size1 = level(before, p)
    one = np.where(size1 > 0, (n1 + MU * p) / (size1 + MU), p)
    n2, size2 = level((before << np.uint64(32)) | second, one)
    size2 = np.where(second > 0, size2, 0)
    return _answered(frame, lengths, (n1, size1, n2, size2))


def _answered(frame: pd.DataFrame, lengths: list[int], found) -> pd.DataFrame:
    """A packed row for each row of the frame; counts of states that are not retained are zero."""
    ends = np.cumsum(lengths)
    split = [np.split(x.astype(np.uint64), ends[:-1]) for x in found]
    answers = [zlib.compress(np.concatenate([part[i] * (split[1 if k < 2 else 3][i] > 0) for k, part in enumerate(split)]).tobytes(), 1) for i in range(len(lengths))]
    return pd.DataFrame({"chunk": frame["chunk"], "bucket": frame["bucket"], "answer": answers, "kind": 2, "different": 0})


class _Slice:
    """The rows of a slice: the different (word, hot word before, word before that) with their counts over all chunks."""

    def __init__(self, frame: pd.DataFrame, usual: np.ndarray):
        self.lengths = [len(x) // 12 for x in frame["items"]]
        minor = np.concatenate([np.frombuffer(x, np.uint64, m) for x, m in zip(frame["items"], self.lengths)])
        code = np.concatenate([np.frombuffer(x, np.uint32, m, 8 * m) for x, m in zip(frame["items"], self.lengths)])
        order, starts, self.row = _grouped(code, minor)
        self.n2 = np.add.reduceat(np.concatenate(_counts(frame["counts"]))[order].astype(np.float64), starts)
        self.pair, code = minor[order][starts], code[order][starts]
        self.hot, self.p = (self.pair >> np.uint64(48)).astype(np.int64), _rates(code, usual)
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (self.hot[1:] != self.hot[:-1])
        self.first = np.flatnonzero(new)
        self.n1 = np.add.reduceat(self.n2, self.first)[np.cumsum(new) - 1]

    def words_before(self) -> pd.DataFrame:
        hot, n1 = self.hot[self.first], self.n1[self.first]
        parts, sizes = np.bincount(hot, _part(n1, self.p[self.first])), np.bincount(hot, n1)
        at = np.flatnonzero(sizes)
        return pd.DataFrame({"place": at, "part": parts[at], "size": sizes[at].astype(np.int64)})

    def sizes_before(self, kept: pd.DataFrame) -> np.ndarray:
        """Size of each row's state of one word, 0 where it is not retained."""
        size = np.zeros(max(int(self.hot.max()) + 1, FREQUENT))
        size[np.asarray(kept["places"].iloc[0], np.int64)] = np.asarray(kept["sizes"].iloc[0], np.float64)
        return size[self.hot]

    def pairs(self, buckets: int):
        """The rows with a state of two words, each one's number among these states, and the states in order of (bucket, state)."""
        rows = np.flatnonzero(self.pair & np.uint64(2**48 - 1))
        bucket = words.mix(self.pair[rows]) % np.uint64(buckets)
        order, starts, group = _grouped(bucket, self.pair[rows])
        return rows, group, bucket[order][starts], self.pair[rows][order][starts]


_PAIRS = "slice long, bucket long, items binary, parts binary, sizes binary"


def _send_pairs(frame: pd.DataFrame, kept: pd.DataFrame, usual: np.ndarray, buckets: int) -> pd.DataFrame:
    """One packed row per bucket of states: this slice's part of their gains and sizes."""
    empty = pd.DataFrame({"slice": [], "bucket": [], "items": [], "parts": [], "sizes": []})
    if not len(frame) or not len(kept):  # a slice without rows, a bucket that is no slice
        return empty
    own = _Slice(frame, usual)
    rows, group, bucket, pair = own.pairs(buckets)
    if not len(pair):
        return empty
    size1 = own.sizes_before(kept)
    one = np.where(size1 > 0, (own.n1 + MU * own.p) / (size1 + MU), own.p)
    parts = np.bincount(group, _part(own.n2, one)[rows])
    sizes = np.bincount(group, own.n2[rows]).astype(np.uint32)
    cut = [*np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(bucket)]
    packed = [(int(bucket[a]), pair[a:b].tobytes(), parts[a:b].tobytes(), zlib.compress(sizes[a:b].tobytes(), 1)) for a, b in zip(cut[:-1], cut[1:])]
    out = pd.DataFrame(packed, columns=["bucket", "items", "parts", "sizes"])
    return out.assign(slice=int(frame["bucket"].iloc[0]))[["slice", "bucket", "items", "parts", "sizes"]]


def _judge_pairs(frame: pd.DataFrame) -> pd.DataFrame:
    """For each slice's states their sizes, 0 where a state is not retained."""
    items = [np.frombuffer(x, np.uint64) for x in frame["items"]]
    _, group = np.unique(np.concatenate(items), return_inverse=True)
    size = np.bincount(group, np.concatenate(_counts(frame["sizes"])))
    parts = np.bincount(group, np.concatenate([np.frombuffer(x, np.float64) for x in frame["parts"]]))
    told = np.where(_gain(parts, size) >= GAIN, size, 0).astype(np.uint64)[group]
    answers = [zlib.compress(x.tobytes(), 1) for x in np.split(told, np.cumsum([len(x) for x in items])[:-1])]
    return pd.DataFrame({"bucket": frame["slice"], "pairs": frame["bucket"], "answer": answers})


def _dealt_states(frame: pd.DataFrame, told: pd.DataFrame, usual: np.ndarray, buckets: int) -> pd.DataFrame:
    """As _states, for the rows of a slice."""
    own = _Slice(frame, usual)
    judged = told["places"].isna()
    size1, size2 = own.sizes_before(told[~judged]), np.zeros(len(own.pair))
    rows, group, _, pair = own.pairs(buckets)
    if len(pair):
        sizes = np.concatenate([np.frombuffer(zlib.decompress(x), np.uint64) for x in told[judged].sort_values("pairs")["answer"]])
        _same_number(len(sizes), len(pair))
        size2[rows] = sizes[group]
    return _answered(frame, own.lengths, tuple(x[own.row] for x in (own.n1, size1, own.n2, size2)))


def _same_number(answers: int, items: int) -> None:
    if answers != items:
        raise RuntimeError(f"{answers} answers for {items} items of a chunk: its rows were not in one task")


_ANSWER = "chunk long, bucket long, answer binary, kind int, different long"


def score(docs: DataFrame, held: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities)."""
    rows = _chunked(docs, held)
    tasks = rows.select(F.spark_partition_id().alias("task")).distinct().count()
    buckets = max(64, tasks)
    slices = SLICES * buckets

    def send_words(batches):
        for chunk, texts, train in _by_chunk(batches):
            tokens, owners = _tokens(texts)
            del texts
            major, minor = _word_rows(tokens, buckets)
            batch = _sent(chunk, major, minor, train[owners], lambda m: m, lambda _, w: w.tobytes())
            if batch is not None:
                yield batch

    sent = stored(rows.select("chunk", "text", "train").mapInArrow(send_words, _SENT), "words")
    total = sent.agg(F.sum("total")).first()[0] or 0
    limit = total / FREQUENT
    known = stored(sent.groupBy("bucket").applyInPandas(lambda frame: _sum_words(frame, limit), _ANSWER), "counts")
    marks = known.where("kind = 1").select("answer", "different").collect()  # at most FREQUENT words in all
    different = sum(m.different for m in marks)
    found = [np.frombuffer(m.answer, np.uint64).reshape(2, -1) for m in marks]
    often = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.uint64)
    often = often[:, np.argsort(often[0])]
    floor = total + 0.1 * (different + 1)
    rates = np.concatenate([(often[1].astype(np.float64) + 0.1) / floor, [1.0]])
    shared = docs.sparkSession.sparkContext.broadcast((often[0], rates, often[1] > HOT * total / slices))

    def send_contexts(batches):
        for chunk, texts, train in _by_chunk(batches):
            tokens, owners = _tokens(texts)
            del texts
            at, major, minor = _context_rows(tokens, owners, shared.value[0], shared.value[2], slices)

            def pack(a, b):
                if a[0] >> np.uint64(32) >= slices:
                    return b.tobytes() + a.astype(np.uint32).tobytes()
                return np.concatenate([a & np.uint64(0xFFFFFFFF), b >> np.uint64(32), b & np.uint64(0xFFFFFFFF)]).astype(np.uint32).tobytes()

            batch = _sent(chunk, major, minor, train[owners[at]], lambda m: m >> np.uint64(32), pack)
            if batch is not None:
                yield batch

    contexts = rows.select("chunk", "text", "train").mapInArrow(send_contexts, _SENT)
    by_bucket = contexts.groupBy("bucket")

    def words_before(frame):
        is_slice = frame["bucket"].iloc[0] >= slices
        return _Slice(frame, shared.value[1]).words_before() if is_slice else pd.DataFrame({"place": [], "part": [], "size": []})

    def states(frame, told):
        if not len(frame):
            return pd.DataFrame({"chunk": [], "bucket": [], "answer": [], "kind": [], "different": []})
        is_slice = frame["bucket"].iloc[0] >= slices
        return _dealt_states(frame, told, shared.value[1], slices) if is_slice else _states(frame, shared.value[1])

    # the same shuffle of contexts serves all three steps
    sums = by_bucket.applyInPandas(words_before, "place long, part double, size long").groupBy("place").agg(F.sum("part").alias("part"), F.sum("size").alias("size"))
    gain = F.col("part") - F.col("size") * F.log(F.greatest(F.col("size") - 1, F.lit(0)) + MU)
    # one row, of at most FREQUENT words
    kept = sums.where(gain >= GAIN).agg(F.collect_list("place").alias("places"), F.collect_list("size").alias("sizes"))
    kept = docs.sparkSession.range(slices, 2 * slices).withColumnRenamed("id", "bucket").crossJoin(F.broadcast(kept)).select("bucket", "places", "sizes")
    pairs = by_bucket.cogroup(kept.groupBy("bucket")).applyInPandas(lambda frame, own: _send_pairs(frame, own, shared.value[1], slices), _PAIRS)
    judged = pairs.groupBy("bucket").applyInPandas(_judge_pairs, "bucket long, pairs long, answer binary")
    told = judged.unionByName(kept, allowMissingColumns=True)
    states = by_bucket.cogroup(told.groupBy("bucket")).applyInPandas(states, _ANSWER)
    answers = known.where("kind = 0").unionByName(states)

    def rate(own: pa.Table, told: pa.Table) -> pa.Table:
        n_docs = 0
        if own.num_rows:
            own = pa.concat_tables([pa.ipc.open_stream(docs.as_buffer()).read_all() for docs in own["docs"]])
            n_docs = own.num_rows
        if not n_docs:
            return pa.table({"doc_id": [], "train": [], "n_tokens": [], "n_known": [], "base_score": [], "score": []}, schema=result)
        tokens, owners = _tokens(own["text"].combine_chunks())
        told = told.select(["kind", "bucket", "answer"]).to_pandas().sort_values(["kind", "bucket"])
        counts = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(zlib.decompress(x), np.uint64) for x in told["answer"][told["kind"] == 0])])
        _, starts, group = _grouped(*_word_rows(tokens, buckets))
        _same_number(len(counts), len(starts))
        c = counts[group].astype(np.float64)
        p = (c + 0.1) / floor
        base = np.bincount(owners, weights=np.log10(p), minlength=n_docs)
        at, major, minor = _context_rows(tokens, owners, shared.value[0], shared.value[2], slices)
        if len(at):
            _, starts, group = _grouped(major, minor)
            parts = np.concatenate([np.frombuffer(zlib.decompress(x), np.uint64).reshape(4, -1) for x in told["answer"][told["kind"] == 2]], axis=1)
            _same_number(parts.shape[1], len(starts))
            q = p[at]
            for n, sizes in (parts[:2], parts[2:]):
                size = sizes[group].astype(np.float64)
                q = np.where(size > 0, (n[group] + MU * q) / (size + MU), q)
            p[at] = q
        full = np.bincount(owners, weights=np.log10(p), minlength=n_docs)
        n = np.bincount(owners, minlength=n_docs)
        return pa.table([own["doc_id"], own["train"], pa.array(n), pa.array(np.bincount(owners, weights=c > 0, minlength=n_docs).astype(np.int64)), pa.array(base), pa.array(full)], schema=result)

    result = pa.schema([("doc_id", pa.int64()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    packed = rows.mapInArrow(_packed_docs, "chunk long, docs binary")
    rated = packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        rate, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return rated.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
