"""Words of whole texts and their 64-bit hashes, for code that runs in Python workers.

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D``. Words are found and
hashed for many texts at once, straight from an Arrow column, without an object for
each word. A hash is a sum of random values, one for each byte and its place in the
word (tabulation hashing), scrambled together with the length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: The same rule as a pattern for Spark's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of words that are hashed at once; temporary arrays are some 40 times as large.
_AT_ONCE = 1 << 19
_PLACES = 64
_U = np.uint64
_SOLID = np.ones(256, bool)
_SOLID[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (two multiply-xorshift rounds)."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_VALUES = mixed(mixed(np.arange(1, _PLACES * 256 + 1, dtype=_U)) + _U(0x9E3779B97F4A7C15))


@dataclass
class Words:
    """Words of texts that lie one after the other in ``data``: text k has words first[k] to first[k + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One 64-bit value for each word; with ``lower``, of the word with A to Z in lower case."""
        out = np.empty(len(self.starts), _U)
        upto = np.cumsum(self.ends - self.starts)
        k = 0
        while k < len(out):
            stop = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + _AT_ONCE)))
            length = self.ends[k:stop] - self.starts[k:stop]
            begin = np.cumsum(length) - length
            place = np.arange(begin[-1] + length[-1]) - np.repeat(begin, length)
            byte = self.data[np.repeat(self.starts[k:stop], length) + place]
            value = _VALUES[(place & (_PLACES - 1)) * 256 + (_LOWER[byte] if lower else byte)]
            if length.max() > _PLACES:
                late = np.flatnonzero(place >= _PLACES)
                value[late] = mixed(value[late] + (place[late] // _PLACES).astype(_U) * _U(0xA0761D6478BD642F))
            out[k:stop] = mixed(np.add.reduceat(value, begin) + length.astype(_U) * _U(0xE7037ED1A0B428DB))
            k = stop
        return out


def words_in(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts data[offsets[k]:offsets[k + 1]]."""
    solid = _SOLID[data]
    edge = np.empty(len(data) + 1, bool)
    edge[:1] = edge[-1:] = True
    edge[1:-1] = ~solid[:-1]  # a word may start here: nothing solid before, or a text begins
    edge[offsets] = True
    starts = np.flatnonzero(solid & edge[:-1])
    edge[:-1] = ~solid
    edge[offsets] = True  # a word ends before here
    edge[-1:] = True
    ends = np.flatnonzero(solid & edge[1:]) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column, without a copy; null is empty."""
    if column.type != pa.large_binary():
        column = column.cast(pa.large_binary())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array | list[bytes]) -> Words:
    if isinstance(column, list):
        column = pa.array(column, pa.large_binary())
    return words_in(*buffer_of(column))


def slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``most`` bytes each, one row at least."""
    _, offsets = buffer_of(column)
    k = 0
    while k < len(column):
        stop = max(k + 1, int(np.searchsorted(offsets, offsets[k] + most, "right")) - 1)
        yield k, stop
        k = stop


def hashes(words: list[bytes]) -> np.ndarray:
    """Of words given one by one."""
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if words else ends
    return Words(np.frombuffer(b"".join(words), np.uint8), starts, ends, starts).hashes()


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words; empty if there are fewer."""
    k = len(h) - n + 1
    if k <= 0:
        return np.empty(0, _U)
    out = h[:k].copy()
    for j in range(1, n):
        out *= _U(0x9E3779B97F4A7C15)
        out ^= out >> _U(31)
        out += h[j : j + k]
    return mixed(out)
