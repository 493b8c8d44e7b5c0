"""Words and their 64-bit hashes for a batch of texts, without a Python step per word.

A batch is one byte string; positions of words and sums of weighted bytes are numpy arrays over it. The hash of a run of
bytes b0..bn is the sum of T[bj] * P**j modulo 2**64, T and P fixed and odd, followed by a mixing step. It is taken from
prefix sums, so any run (a word, a line) costs a few array operations. Two different runs agree with a chance of about
2**-60.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Characters that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 2**64))
_BYTES = np.random.default_rng(20240101).integers(0, 2**63, 256, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}
# Bytes handled at once; only a longer single text makes a larger piece.
PIECE = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1)."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        size = max(n, PIECE + 1)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _powers[int(base)] = known
    return known[:n]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every run data[start:end] (uint64); an empty run gives the hash of nothing."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _power(_ODD, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def text_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of bytes and the n+1 offsets of the texts in it; null counts as empty."""
    column = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    column = column if isinstance(column, pa.Array) else pa.array(column, pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray):
    """Ranges of texts (a, b) of at most PIECE bytes together, or of one text."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + PIECE, side="right")) - 1)
        yield a, b
        a = b


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words before each text (n+1 numbers)."""
    inside = ~SPACE[data]
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        before[cuts] = False  # a word does not run on into the next text
        after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def word_hashes(texts, lower: bool = True):
    """Yield (first text, last text + 1, hashes of words, words before each text of the range)."""
    data, offsets = text_bytes(texts)
    for a, b in pieces(offsets):
        part = data[offsets[a] : offsets[b]]
        part = _LOWER[part] if lower else part
        starts, ends, counts = word_spans(part, offsets[a : b + 1] - offsets[a])
        yield a, b, run_hashes(part, starts, ends), counts


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of one text; with fewer words, of the whole sequence."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(k, n)
    out = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        out = mix(out * _ODD + hashes[j : n - width + 1 + j])
    return np.unique(out if width == k else mix(out + np.uint64(width)))
