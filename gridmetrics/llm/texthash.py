"""Words of Arrow text columns as 64-bit hashes, in numpy.

Used inside ``mapInArrow`` tasks: one batch of texts is one byte buffer, and
word bounds, hashes and n-grams come from array operations on it, a few
megabytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once.
CHUNK_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into them) of each part of a
    text column; null counts as empty. A part holds about ``size`` bytes or one
    longer text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32,
                            count=texts.offset + n + 1)[texts.offset:].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each row and the end): words in order."""
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | edge[1:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    bounds = np.searchsorted(starts, offsets, "left")
    letters = data[word]
    if lower:
        letters = _LOWER[letters]
    number = np.cumsum(word) - 1
    first = number[starts]
    sizes = np.diff(first, append=len(letters))
    place = np.arange(len(letters), dtype=np.int64) - np.repeat(first, sizes)
    power = np.cumprod(np.full(int(sizes.max()) + 1, _BASE, np.uint64))
    parts = (letters.astype(np.uint64) + np.uint64(1)) * power[place]
    return mix64(np.add.reduceat(parts, first) + sizes.astype(np.uint64)), bounds


def run_hashes(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the sequences of ``width`` words within each row, and their row
    bounds. A row with fewer words has one: that of all its words."""
    n = np.diff(bounds)
    at = np.concatenate([[0], np.cumsum(np.where(n >= width, n - width + 1, np.minimum(n, 1)))])
    out, h = np.empty(at[-1], np.uint64), words
    for k in range(1, width + 1):  # h: hashes of k words from each place on
        if k > 1:
            h = mix64(h[:-1] * np.uint64(3) + mix64(words[k - 1:]))
        if k < width:
            short = np.flatnonzero(n == k)
            out[at[short]] = mix64(h[bounds[short]] ^ (np.uint64(0x5851F42D4C957F2D) + np.uint64(k)))
    full = np.flatnonzero(n >= width)
    size = n[full] - width + 1
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at[full], size) + inside] = h[np.repeat(bounds[full], size) + inside]
    return out, at


def pair_hashes(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the two-word sequences within each row, and their row bounds."""
    n = np.diff(bounds)
    if not len(words):
        return words, bounds.copy()
    both = mix64(words[:-1] * np.uint64(3) + mix64(words[1:]))
    inside = np.ones(len(words), bool)
    inside[(bounds[1:] - 1)[n > 0]] = False
    at = np.concatenate([[0], np.cumsum(np.maximum(n - 1, 0))])
    return both[inside[:-1]], at
