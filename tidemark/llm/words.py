"""Words of many texts at once, as numpy arrays over one UTF-8 buffer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: UTF-8 bytes of the texts that are taken together; one longer text is taken alone.
CHUNK = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that end a word: space and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that are not of a lower-cased alphanumeric word: all of ASCII but 0-9 and a-z.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[0x00:0x30] = NOT_ALNUM[0x3A:0x61] = NOT_ALNUM[0x7B:0x80] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of some texts: `first[d]` to `first[d + 1]` are those of text d; each is `data[start:end]`."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, from one running sum over the buffer."""
        global _UP, _DOWN
        n = len(self.data) + 1
        if len(_UP) < n:
            _UP, _DOWN = _powers(_BASE, n), _powers(_INVERSE, n)
        total = np.zeros(n, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _UP[: n - 1], out=total[1:])
        return mix((total[self.end] - total[self.start]) * _DOWN[self.start] + (self.end - self.start).astype(np.uint64))

    def bytes_of(self, i: int, j: int) -> list[bytes]:
        raw = self.data
        return [raw[a:b].tobytes() for a, b in zip(self.start[i:j], self.end[i:j], strict=True)]


def words_of(data: np.ndarray, offsets: np.ndarray, ends_word: np.ndarray) -> Words:
    """data: UTF-8 of the texts, one after another; offsets: where each begins, and the end."""
    inside = ~ends_word[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    if len(data):
        starts[1:] &= ~inside[:-1] | begins[1:-1]
        ends[:-1] &= ~inside[1:] | begins[1:-1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the offsets of a string column without nulls."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about `size` bytes: first row, row after the last, their bytes, their offsets."""
    if not len(column):
        return
    data, offsets = buffers(column)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, stop, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` word hashes; it belongs to the run's first word. Runs may cross texts."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += words[k : k + n]
    return mix(out)
