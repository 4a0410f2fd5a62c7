"""Keys (as by ``text.norm_key``) of whole Arrow text columns, and digests of their windows of words (numpy, no per-word Python).

The key of a text is made byte by byte from tables, so that it costs some nanoseconds a letter; ``norm_key`` in the JVM costs about a
hundred times as much on long texts. Keys of at most ``PIECE`` bytes of texts (or of one longer text) are in memory at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .text import ACCENTED, PLAIN

#: Bytes of texts whose keys are made in one step, and windows whose digests are.
PIECE, WINDOWS = 1 << 19, 1 << 15

_SPACE, _DROPPED, _AND = 32, 0, 1
_DELETED = "'’`´"
#: Letters of three bytes that are no space in a key: the apostrophe, and the Kelvin sign (its lower case is the letter k).
_THREE = {0x2019: _DROPPED, 0x212A: ord("k")}


def _letter(c: str) -> int:
    if c in _DELETED:
        return _DROPPED
    low = dict(zip(ACCENTED, PLAIN)).get(c, c).lower()
    return _AND if c == "&" else ord(low) if low.isascii() and low.isalnum() else _SPACE


#: By first byte; bytes that go on with a letter are dropped. Letters of two bytes by their number.
_ONE = np.array([_letter(chr(b)) if b < 0x80 else _DROPPED if b < 0xC0 else _SPACE for b in range(256)], np.uint8)
_TWO = np.array([_letter(chr(c)) for c in range(0x800)], np.uint8)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.Generator(np.random.PCG64(20261130)).integers(1, 1 << 64, 256, dtype=np.uint64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base, and of its inverse."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            full = np.full(max(n, PIECE), base, np.uint64)
            full[0] = 1
            _POWERS[k] = np.multiply.accumulate(full)
    return _POWERS


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Keys:
    """Keys of consecutive texts, each with a space behind it: ``start`` and ``end`` of every word in ``text``, ``doc_at``: the number of the first word of each text, and of all words."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray):
        raw, stops = raw[int(offs[0]) : int(offs[-1])], offs[1:] - offs[0]
        v = _ONE[raw]
        high = np.flatnonzero(raw >= 0xC0)
        lead, then, last = raw[high], np.take(raw, high + 1, mode="clip"), np.take(raw, high + 2, mode="clip")
        two = lead < 0xE0
        v[high[two]] = _TWO[(lead[two].astype(np.int64) & 31) << 6 | then[two] & 63]
        number = (lead.astype(np.int64) & 15) << 12 | (then.astype(np.int64) & 63) << 6 | last & 63
        for c, to in _THREE.items():
            v[high[(lead >> 4 == 14) & (number == c)]] = to
        ands = np.flatnonzero(v == _AND)
        v[ands] = _SPACE
        v = np.insert(v, np.concatenate([np.repeat(ands + 1, 4), stops]), np.concatenate([np.tile(np.frombuffer(b"and ", np.uint8), len(ands)), np.full(len(stops), _SPACE, np.uint8)]))
        stops = stops + 4 * np.searchsorted(ands + 1, stops, "right") + np.arange(len(stops))
        dropped = np.flatnonzero(v == _DROPPED)
        v, stops = v[v != _DROPPED], stops - np.searchsorted(dropped, stops)
        word = v != _SPACE
        ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
        self.doc_at = np.concatenate([[0], np.searchsorted(ends, stops, "right")])
        word[ends] = True
        self.text = v[word]
        self.end = np.flatnonzero(self.text == _SPACE)
        self.start = np.concatenate([[0], self.end + 1])[:-1]

    def cut(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The words from each number ``first`` to each ``last``, with a space between them."""
        begin, sizes = self.start[first], self.end[last] - self.start[first]
        offs = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        data = self.text[np.arange(offs[-1]) + np.repeat(begin - offs[:-1], sizes)]
        return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offs), pa.py_buffer(data)).cast(pa.string())

    def whole(self) -> pa.Array:
        """The key of each text."""
        some = np.flatnonzero(np.diff(self.doc_at))
        places = np.full(len(self.doc_at) - 1, -1)
        places[some] = np.arange(len(some))
        return self.cut(self.doc_at[some], self.doc_at[some + 1] - 1).take(pa.array(places, mask=places < 0)).fill_null("")

    def digests(self, first: slice | np.ndarray, last: slice | np.ndarray) -> np.ndarray:
        """64-bit digests of the same runs of words as in ``cut``, in rising order: alike for alike words wherever they stand."""
        s, e = self.start[first], self.end[last]
        if not len(s):
            return np.zeros(0, np.uint64)
        base, n = int(s[0]), int(e[-1] - s[0])
        up, down = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.text[base : base + n]] * up[:n], out=total[1:])
        s, e = s - base, e - base
        return _mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))

    def windows(self, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """Digests of all windows of ``n`` words, some at a time with the number of the first; a window may reach into the next text (``within``)."""
        most = len(self.end) - n + 1
        for a in range(0, most, WINDOWS):
            b = min(a + WINDOWS, most)
            yield a, self.digests(slice(a, b), slice(a + n - 1, b + n - 1))

    def within(self, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of windows those that are of one text, and the texts' numbers."""
        doc = np.searchsorted(self.doc_at, first, "right") - 1
        one = first + n <= self.doc_at[doc + 1]
        return first[one], doc[one]


def keys(column: pa.Array) -> Iterator[tuple[int, Keys]]:
    """The keys of a text column piece by piece, each with the number of its first row; null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = min(len(column), max(at + 1, int(np.searchsorted(offs, offs[at] + PIECE, "right")) - 1))
        yield at, Keys(raw, offs[at : end + 1])
        at = end
