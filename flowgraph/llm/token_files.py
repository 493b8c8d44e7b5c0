"""Token ids in binary files of patched frame-of-reference blocks.

File format (little endian). A file is a row of blocks, then the index of block starts (one u64 per block and one for the end of
the last), then the tail `u64 ids, u64 blocks, u32 ids per block, b"PFB1"`. A block holds `size` ids (the last one is filled up
with its minimum):

    u32 minimum | u8 width | u8 zero | u16 exceptions | size * width bits | u16 place per exception | u32 rest per exception

The minimum is subtracted; `width` is the number of bits that `share` of the block's differences fit in. Of each difference the
low `width` bits are packed; of those that are wider, the exceptions, the bits above are stored in lists with their places. Any
range of ids is read by way of the index, without touching other blocks.

Writing. Rows are dealt to tasks by ranges of (doc_id, hash of the text) and sorted there (Spark's sort spills), and every task
streams its ids into one file in the shared folder. A file's name is unique to the attempt that wrote it, and the index rows
(doc_id, part, path, at, n_tokens), written by Spark, name the files that count: a repeated or lost task leaves at most a file
that nothing refers to. The start of a document is its place in its file plus the ids of all files before, from one row
per file. Reading takes the index rows as they lie, so nothing is shuffled and tasks read ranges of files.

Encoding. The tokenizer must not join what white space separates (its pre-tokenizer matches no white space): then the ids of a
text are those of its pieces between blanks, tabs and line feeds in a row, and a worker encodes each different piece once (some
CACHE of them are remembered at a time; when there are more, the KEPT most used stay). Where the tokenizer marks the ends of words, pieces of letters go through it many in one
string, and the marks that follow letters are encoded apart from them if the tokenizer cuts there too.

The folder is opened by pyarrow.fs (local and shared paths, hdfs, s3, gs).

Defined cases: a null text counts as empty and has the end id only; rows are ordered by doc_id, null first, then by a hash of the
text; rows that repeat id and text stand next to each other, one by one; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import os
import struct
import uuid
from functools import lru_cache
from string import punctuation
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = 128
SHARE = 0.9
END_ID = 1
MAGIC = b"PFB1"
CACHE = 1_000_000
CACHED_IDS = 8_000_000
KEPT = 250_000
# Marks after a run of letters are a piece of their own; pieces of letters only are encoded so many at a time.
MARKS = punctuation.replace("'", "")
TOGETHER = 2000
# Characters encoded at once, ids packed or returned at once; a longer single text is handled whole.
CHARS = 1 << 20
IDS = 1 << 18

_TAIL = struct.Struct("<QQI4s")
_HEAD = 8


# --- blocks --------------------------------------------------------------------------------------------------

def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1]


def _bits_together(values: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bits of each row's numbers in a row, first numbers and low bits first, as bytes; 64 numbers fill `width` words."""
    lanes = np.ascontiguousarray(values.reshape(-1, 64).T).astype(np.uint64) & np.uint64((1 << width) - 1)
    out = np.zeros((width, lanes.shape[1]), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").view(np.uint8).reshape(len(values), -1)


def _bits_apart(packed: np.ndarray, width: int, size: int) -> np.ndarray:
    """The numbers that `_bits_together` packed, `size` to a row."""
    held = np.ascontiguousarray(np.ascontiguousarray(packed).view("<u8").reshape(-1, width).T)
    out = np.empty((64, held.shape[1]), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[i] = held[word] >> np.uint64(shift)
        if shift + width > 64:
            out[i] |= held[word + 1] << np.uint64(64 - shift)
    return np.ascontiguousarray((out & np.uint64((1 << width) - 1)).T).astype(np.uint32).reshape(len(packed), size)


def pack_blocks(ids: np.ndarray, size: int = BLOCK, share: float = SHARE) -> tuple[bytes, np.ndarray]:
    """The blocks of the ids as bytes, and the length of each block; the last block is filled up with its minimum."""
    if size % 64 or not 64 <= size <= 1 << 15:
        raise ValueError(f"a block must hold a multiple of 64 ids up to 32768, not {size}")
    if not 0 < share <= 1:
        raise ValueError(f"share must be in (0, 1], not {share}")
    n = -(-len(ids) // size)
    if n == 0:
        return b"", np.zeros(0, np.int64)
    full = np.empty(n * size, np.uint32)
    full[: len(ids)] = ids
    tail = len(ids) - (n - 1) * size
    full[len(ids) :] = full[(n - 1) * size : (n - 1) * size + tail].min()
    rows = full.reshape(n, size)
    low = rows.min(1)
    apart = rows - low[:, None]
    bits = _bit_lengths(apart)
    width = np.sort(bits, axis=1)[:, int(np.ceil(share * size)) - 1]
    wide = bits > width[:, None]
    lists = wide.sum(1)
    lengths = _HEAD + size * width // 8 + 6 * lists
    starts = np.concatenate([[0], np.cumsum(lengths)])
    out = np.zeros(starts[-1], np.uint8)
    heads = np.zeros((n, _HEAD), np.uint8)
    heads[:, :4] = low.astype("<u4")[:, None].view(np.uint8)
    heads[:, 4] = width
    heads[:, 6:] = lists.astype("<u2")[:, None].view(np.uint8)
    out[starts[:-1, None] + np.arange(_HEAD)] = heads
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        packed = _bits_together(apart[at], int(w))
        out[starts[at, None] + _HEAD + np.arange(packed.shape[1])] = packed
    block, place = np.nonzero(wide)
    if len(block):
        rank = np.arange(len(block)) - np.repeat(np.cumsum(lists) - lists, lists)
        body = starts[block] + _HEAD + size * width[block] // 8
        rest = (apart[block, place] >> width[block].astype(np.uint32)).astype("<u4")
        out[(body + 2 * rank)[:, None] + np.arange(2)] = place.astype("<u2")[:, None].view(np.uint8)
        out[(body + 2 * lists[block] + 4 * rank)[:, None] + np.arange(4)] = rest[:, None].view(np.uint8)
    return out.tobytes(), lengths


def unpack_blocks(data: bytes, starts: np.ndarray, size: int = BLOCK) -> np.ndarray:
    """The ids of the blocks that begin at `starts` (with the end of the last) in data; those of a filled-up last block whole."""
    raw, begin = np.frombuffer(data, np.uint8), np.asarray(starts[:-1], np.int64)
    heads = raw[begin[:, None] + np.arange(_HEAD)]
    low = heads[:, :4].copy().view("<u4")[:, 0]
    width = heads[:, 4].astype(np.int64)
    lists = heads[:, 6:].copy().view("<u2")[:, 0].astype(np.int64)
    apart = np.zeros((len(begin), size), np.uint32)
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        packed = raw[begin[at, None] + _HEAD + np.arange(size * w // 8)]
        apart[at] = _bits_apart(packed, int(w), size)
    if lists.sum():
        block = np.repeat(np.arange(len(begin)), lists)
        rank = np.arange(len(block)) - np.repeat(np.cumsum(lists) - lists, lists)
        body = begin[block] + _HEAD + size * width[block] // 8
        place = raw[(body + 2 * rank)[:, None] + np.arange(2)].copy().view("<u2")[:, 0]
        rest = raw[(body + 2 * lists[block] + 4 * rank)[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
        apart[block, place] |= rest << width[block].astype(np.uint32)
    return (apart + low[:, None]).reshape(-1)


# --- files ---------------------------------------------------------------------------------------------------

def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class TokenWriter:
    """Streams ids into one file; holds less than IDS ids and the index of block starts."""

    def __init__(self, path: str, size: int = BLOCK, share: float = SHARE):
        system, inner = _opened(path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.file, self.size, self.share = system.open_output_stream(inner), size, share
        self.waiting: list[np.ndarray] = []
        self.held, self.ids, self.lengths = 0, 0, [np.zeros(1, np.int64)]

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        self.ids += len(ids)
        if self.held >= IDS:
            self._flush(self.held // self.size * self.size)

    def _flush(self, n: int) -> None:
        together = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        data, lengths = pack_blocks(together[:n], self.size, self.share)
        self.file.write(data)
        self.lengths.append(lengths)
        self.waiting, self.held = [together[n:]], len(together) - n

    def close(self) -> None:
        self._flush(self.held)
        starts = np.cumsum(np.concatenate(self.lengths)).astype("<u8")
        self.file.write(starts.tobytes() + _TAIL.pack(self.ids, len(starts) - 1, self.size, MAGIC))
        self.file.close()


class TokenReader:
    """Reads ranges of ids of one file."""

    def __init__(self, path: str):
        system, inner = _opened(path)
        self.file = system.open_input_file(inner)
        end = self.file.size()
        self.ids, self.blocks, self.size, magic = _TAIL.unpack(self.file.read_at(_TAIL.size, end - _TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a file of token blocks")
        index = 8 * (self.blocks + 1)
        self.starts = np.frombuffer(self.file.read_at(index, end - _TAIL.size - index), "<u8").astype(np.int64)

    def read(self, begin: int, end: int) -> np.ndarray:
        """The ids begin..end-1."""
        if not 0 <= begin <= end <= self.ids:
            raise ValueError(f"ids {begin}..{end} of a file of {self.ids}")
        if begin == end:
            return np.zeros(0, np.uint32)
        first, last = begin // self.size, -(-end // self.size)
        starts = self.starts[first : last + 1]
        data = self.file.read_at(int(starts[-1] - starts[0]), int(starts[0]))
        return unpack_blocks(data, starts - starts[0], self.size)[begin - first * self.size : end - first * self.size]

    def close(self) -> None:
        self.file.close()


# --- encoding ------------------------------------------------------------------------------------------------

@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _word_ends(path: str) -> np.ndarray | None:
    """Which ids end a word, where the tokenizer marks ends and cuts letters from the MARKS that follow them; else None."""
    tokenizer = _tokenizer(path)
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    cut = tokenizer.pre_tokenizer is not None and all(len(tokenizer.pre_tokenizer.pre_tokenize_str(letter + mark)) == 2 for letter in "aé" for mark in MARKS)
    if not suffix or not cut:
        return None
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return out


def _plain(word: str) -> bool:
    """Whether a word is one run of letters, and stays one when it is normalised and lower-cased."""
    return word.isalpha() and (word.isascii() or (is_normalized("NFC", word) and word.lower().isalpha()))


class Encoder:
    """Ids of whole texts, each different piece between white space encoded once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer, self.ends = _tokenizer(path), _word_ends(path)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.starts, self.pool, self.used = np.zeros(1, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _forget_rare(self) -> None:
        """Keep the most used of the pieces, of those with few ids each."""
        short = np.flatnonzero(np.diff(self.starts) <= 8)
        often = np.sort(short[np.argsort(-self.used[short], kind="stable")[: min(KEPT, len(self.number) // 4)]])
        pieces, (ids, sizes) = list(self.number), self._gathered(often)
        self._forget()
        self._add([pieces[i] for i in often], sizes, ids)

    def _add(self, pieces, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.number.update(zip(pieces, range(len(self.number), len(self.number) + len(lengths))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.pool = np.concatenate([self.pool, ids])
        self.used = np.concatenate([self.used, np.zeros(len(lengths), np.int64)])

    def _gathered(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces in a row, and the number of ids of each."""
        begin = self.starts[which]
        sizes = self.starts[which + 1] - begin
        before = np.cumsum(sizes) - sizes
        return self.pool[np.repeat(begin - before, sizes) + np.arange(sizes.sum())], sizes

    def _learn_each(self, pieces: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        self._add(pieces, np.array([len(x) for x in found], np.int64), np.array([i for x in found for i in x], np.uint32))

    def _learn_plain(self, pieces: list[str]) -> None:
        """Pieces that are one run of letters, many at a time: each has one id that ends a word, its last."""
        done, lengths, found, odd = [], [], [], []
        for a in range(0, len(pieces), TOGETHER):
            some = pieces[a : a + TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) == len(some) and last[-1] == len(ids):
                done += some
                lengths.append(np.diff(last, prepend=0))
                found.append(ids)
            else:
                odd += some
        if done:
            self._add(done, np.concatenate(lengths), np.concatenate(found))
        if odd:
            self._learn_each(odd)

    def _learn(self, new: list[str]) -> None:
        if self.ends is None:
            return self._learn_each(new)
        plain, marked, other = {}, [], {}
        for piece in new:
            if _plain(piece):
                plain[piece] = None
                continue
            core = piece.rstrip(MARKS)
            if len(core) < len(piece) and _plain(core):
                marks = piece[len(core) :]
                marked.append((piece, core, marks))
                if core not in self.number:
                    plain[core] = None
                if marks not in self.number:
                    other[marks] = None
            else:
                other[piece] = None
        self._learn_plain(list(plain))
        self._learn_each(list(other))
        if marked:
            ids, sizes = self._gathered(np.array([self.number[x] for _, core, marks in marked for x in (core, marks)], np.int64))
            self._add([piece for piece, _, _ in marked], sizes[::2] + sizes[1::2], ids)

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, each text followed by end_id, and the number of ids of each text."""
        spaced = pa.array(texts, pa.large_string())
        for blank in "\n\t":
            spaced = pc.replace_substring(spaced, blank, " ")
        split = pc.split_pattern(spaced, " ")
        flat = split.flatten().dictionary_encode()
        different = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = list(map(self.number.get, different))
        missing = [i for i, place in enumerate(places) if place is None]
        if missing:
            self._learn([different[i] for i in missing])
            for i in missing:
                places[i] = self.number[different[i]]
        which = np.array(places, np.int64)[flat.indices.to_numpy()]
        self.used += np.bincount(which, minlength=len(self.used))
        found, sizes = self._gathered(which)
        last = np.cumsum(split.value_lengths().to_numpy())
        counts = np.diff(np.concatenate([[0], np.cumsum(sizes)])[last], prepend=0)
        ids = np.insert(found, np.cumsum(counts), np.uint32(end_id))
        if len(self.number) > CACHE or self.starts[-1] > CACHED_IDS:
            self._forget_rare()
        return ids, counts + 1


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """What a worker process has learned stays with it from task to task."""
    return Encoder(path)


def _groups(texts: list[str]):
    """The texts in runs of at most CHARS characters together, or of one text."""
    run, held = [], 0
    for text in texts:
        if run and held + len(text) > CHARS:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run


# --- tables --------------------------------------------------------------------------------------------------

_INDEX = "doc_id long, part int, path string, at long, n_tokens long"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, size: int = BLOCK, share: float = SHARE) -> DataFrame:
    """Write the ids of all texts in ascending order of doc_id to files below `folder`; returns the index, also written there.

    `tokenizer` is the path of a tokenizers file that every machine can read. Index: doc_id, start, n_tokens, path, at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("th").asc()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches):
        part, path, encoder, writer = TaskContext.get().partitionId(), "", _encoder(tokenizer), None
        for batch in batches:
            ids = batch.column(0)
            done = 0
            for texts in _groups(batch.column(1).to_pylist()):
                if writer is None:
                    path = f"{folder}/ids/part-{part:06d}-{uuid.uuid4().hex}.pfb"
                    writer = TokenWriter(path, size, share)
                tokens, counts = encoder.encode(texts, end_id)
                at = writer.ids + np.cumsum(counts) - counts
                writer.add(tokens)
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(done, n), pa.array([part] * n, pa.int32()), pa.array([path] * n), pa.array(at, pa.int64()), pa.array(counts, pa.int64())],
                    ["doc_id", "part", "path", "at", "n_tokens"],
                )
                done += n
        if writer is not None:
            writer.close()

    spark = docs.sparkSession
    dealt.mapInArrow(write, _INDEX).write.parquet(f"{folder}/places")
    places = spark.read.schema(_INDEX).parquet(f"{folder}/places")
    # One row per file.
    sizes = places.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before"))
    index = places.join(F.broadcast(offsets), "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "path", "at")
    index.write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("doc_id long, start long, n_tokens long, path string, at long").parquet(f"{folder}/index")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit numbers), read from the files of a folder."""

    def read(batches):
        path, reader = None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(5)]
            starts = np.cumsum([0, *columns[2]])
            a = 0
            while a < batch.num_rows:
                # documents that follow each other in one file are read together
                b = a + 1
                while b < batch.num_rows and columns[3][b] == columns[3][a] and columns[4][b] == columns[4][b - 1] + columns[2][b - 1] and starts[b + 1] - starts[a] <= IDS:
                    b += 1
                if columns[3][a] != path:
                    if reader is not None:
                        reader.close()
                    path, reader = columns[3][a], TokenReader(columns[3][a])
                begin = columns[4][a]
                data = reader.read(begin, begin + int(starts[b] - starts[a])).astype("<u4").tobytes()
                cuts = 4 * (starts[a : b + 1] - starts[a])
                ids = pa.array([data[x:y] for x, y in zip(cuts[:-1], cuts[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in range(3)), ids], ["doc_id", "start", "n_tokens", "ids"])
                a = b
        if reader is not None:
            reader.close()

    return read_index(spark, folder).mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
