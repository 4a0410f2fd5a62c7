"""Vectorised word and shingle hashing of whole Arrow text columns (numpy, no per-word Python).

Words are the runs ``[^\\x20\\x09-\\x0D]+``; A-Z is lower-cased first, other letters stay.
All functions work on one Arrow batch, so their memory is bounded by the batch (and by
``MAX_BYTES`` pieces of it, or by one document where a single text is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed in one vectorised step; the step takes many times as much memory.
MAX_BYTES = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 64, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: ASCII punctuation counts as white space too where edited copies are to be met.
_SPACE_OR_MARK = _SPACE.copy()
_SPACE_OR_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (xor-shift and multiply, three rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, MAX_BYTES + 1)
        for k, base in enumerate((_BASE, _INV)):
            full = np.full(size, base, np.uint64)
            full[0] = 1
            _POWERS[k] = np.multiply.accumulate(full)
    return _POWERS[0], _POWERS[1]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offs


def pieces(offs: np.ndarray, most: int = MAX_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each (a longer single row stands alone)."""
    at, n = 0, len(offs) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1)
        yield at, min(end, n)
        at = min(end, n)


class Words:
    """Words of consecutive documents: ``start``/``end`` byte places, ``doc_at`` word offsets, ``hash``."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray, lower: bool = True, marks: bool = True):
        base, stop = int(offs[0]), int(offs[-1])
        self.raw, self.offs = raw[base:stop], offs - base
        n = stop - base
        word = ~(_SPACE if marks else _SPACE_OR_MARK)[self.raw]
        first = np.zeros(n, bool)
        first[self.offs[:-1][self.offs[:-1] < n]] = True
        begins = word.copy()
        begins[1:] &= ~word[:-1] | first[1:]
        ends = word.copy()
        ends[:-1] &= ~word[1:] | first[1:]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.doc_at = np.searchsorted(self.start, self.offs)
        up, down = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((_BYTE_LOWER if lower else _BYTE)[self.raw] * up[:n], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))


_SHINGLE = (2 * _RNG.integers(1, 1 << 62, 64, dtype=np.uint64)) | np.uint64(1)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` consecutive entries (empty if there are fewer)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out += words[k : len(words) - n + 1 + k] * _SHINGLE[k]
    return mix(out)


def shingle_sets(column: pa.Array, n: int = 5) -> Iterator[np.ndarray]:
    """For each row, the sorted distinct hashes of its ``n``-word shingles.

    Fewer words: the whole sequence is one shingle. No word: an empty set.
    """
    raw, offs = text_buffers(column)
    for a, b in pieces(offs):
        words = Words(raw, offs[a : b + 1])
        every = window_hashes(words.hash, n)
        for i in range(b - a):
            lo, hi = int(words.doc_at[i]), int(words.doc_at[i + 1])
            if hi - lo >= n:
                own = np.sort(every[lo : hi - n + 1])
                yield own[np.r_[True, own[1:] != own[:-1]]]
            elif hi > lo:
                short = words.hash[lo:hi] * _SHINGLE[: hi - lo]
                yield mix(short.sum(dtype=np.uint64, keepdims=True) + np.uint64(hi - lo))
            else:
                yield np.zeros(0, np.uint64)
