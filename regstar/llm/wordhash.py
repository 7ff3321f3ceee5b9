"""Hashes of words and word runs, computed by numpy over the bytes of Arrow string columns.

Used inside Arrow tasks. A word's hash is a random linear form of its bytes
modulo 2^64, finished with a bit mixer; a run's hash is a random linear form of
its words' hashes. The random numbers are fixed by seeds, so hashes agree across
tasks, machines and runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; longer texts are cut between words.
SLICE_BYTES = 4 << 20

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: ASCII other than digits and letters stands between words.
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[:128] = [not chr(b).isalnum() for b in range(128)]

AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective bit mixer."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def randoms(seed: int, n: int) -> np.ndarray:
    """n fixed odd 64-bit numbers; a longer list begins with a shorter one."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed << 32)) | np.uint64(1)


@dataclass
class Words:
    """Words of a batch of texts: word i has bytes start[i] to end[i] of ``data``;
    text k has words first[k] to first[k + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


_weights: dict[int, np.ndarray] = {}


def _word_weights(seed: int, n: int) -> np.ndarray:
    w = _weights.get(seed)
    if w is None or len(w) < n:
        w = _weights[seed] = randoms(seed, max(n, 64))
    return w


def _hash_slice(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of the words at start..end (in order, apart) of some bytes."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    size = end - start
    stop = np.cumsum(size)
    begin = stop - size
    total = int(stop[-1])
    inside = np.arange(total) - np.repeat(begin, size)  # place in the word
    letters = fold[data[np.repeat(start, size) + inside]].astype(np.uint64) + np.uint64(1)
    w = _word_weights(seed, int(size.max()))
    return mix(np.add.reduceat(letters * w[inside], begin) + size.astype(np.uint64))


def split_words(text: pa.Array, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, start, end, first) of the words of a string array, as in ``Words``; NULL has none."""
    if pa.types.is_large_string(text.type):
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)
    else:
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int32)
    offsets = offsets[text.offset:text.offset + len(text) + 1].astype(np.int64)
    raw = text.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = np.empty(len(data) + 1, dtype=bool)
    inside[:-1] = ~separators[data]
    inside[-1] = False
    before = np.empty(len(data) + 1, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets] = False  # words don't run on from one text into the next
    start = np.flatnonzero(inside & ~before)
    follows = inside.copy()
    follows[offsets] = False
    ends = np.flatnonzero(inside[:-1] & ~follows[1:]) + 1
    return data, start, ends, np.searchsorted(start, offsets)


def words_of(text: pa.Array, separators: np.ndarray = SPACES, fold: np.ndarray = AS_IS, seed: int = 1) -> Words:
    """Words of a string array; NULL has none."""
    data, start, ends, first = split_words(text, separators)
    hashes = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        upto = max(at + 1, int(np.searchsorted(start, start[at] + SLICE_BYTES)))
        hashes[at:upto] = _hash_slice(data, start[at:upto], ends[at:upto], fold, seed)
        at = upto
    return Words(data, start, ends, first, hashes)


def beginnings(w: Words, most: int, fold: np.ndarray = AS_IS, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash of its first ``most`` bytes) of the words that are longer."""
    at = np.flatnonzero(w.end - w.start > most)
    start, step = w.start[at], 1 << 20
    parts = [_hash_slice(w.data, start[k:k + step], start[k:k + step] + most, fold, seed) for k in range(0, len(at), step)]
    return at, np.concatenate([np.zeros(0, dtype=np.uint64), *parts])


def runs(h: np.ndarray, n: int, seed: int = 11) -> np.ndarray:
    """Hash of each n consecutive entries; the caller drops those that leave a text."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    w = randoms(seed, n)
    total = h[:len(h) - n + 1] * w[0]
    for k in range(1, n):
        total += h[k:len(h) - n + 1 + k] * w[k]
    return mix(total)


def doubled(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of runs of 2 n entries from those of n entries."""
    a, b = randoms(23, 2)
    return mix(h[:-n] * a + h[n:] * b) if len(h) > n else np.zeros(0, dtype=np.uint64)


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text; at least a row each."""
    text = batch.column(column)
    width = np.int64 if pa.types.is_large_string(text.type) else np.int32
    if not len(text):
        return
    offsets = np.frombuffer(text.buffers()[1], dtype=width)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    at = 0
    while at < len(text):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end
