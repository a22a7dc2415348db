"""An FM-index over words, and matching statistics of streamed words up to a bounded length.

The text is a sequence of words with separators between pieces. Its places are
sorted by the next ``depth`` words; the word before each place, in that order, is
kept in a wavelet matrix: one bit vector per bit of a word's number, packed into
64-bit words with a running count for each. The places themselves are not kept, only
which piece each row is from.

A stream is read from its end. The index keeps the interval of rows that start with
the longest match at the current place. A word to the left extends it by one step of
backward search; if no row goes on with that word, the match is shortened at its right
end to the next length at which more rows agree, and tried again. Matches are not
followed beyond ``depth`` words, so ordering by ``depth`` words is enough: a step only
needs the rows of the interval to lie together and those before it to be smaller.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64


class BitRank:
    """Bits packed into 64-bit words, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(_U)
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.int32)
        self.ones = int(ones.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        k = at >> 6
        mask = (_U(1) << (at & 63).astype(_U)) - _U(1)
        return self.before[k] + np.bitwise_count(self.words[k] & mask)


class WaveletMatrix:
    def __init__(self, values: np.ndarray, most: int):
        self.levels: list[BitRank] = []
        self.zeros: list[int] = []
        self.shifts = list(range(max(1, int(most).bit_length()) - 1, -1, -1))
        for shift in self.shifts:
            bits = ((values >> shift) & 1).astype(np.uint8)
            self.levels.append(BitRank(bits))
            self.zeros.append(len(values) - self.levels[-1].ones)
            values = np.concatenate([values[bits == 0], values[bits == 1]])

    def ranks(self, value: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each value occurs before ``low`` and before ``high``."""
        start = np.zeros(len(value), np.int64)
        for level, zeros, shift in zip(self.levels, self.zeros, self.shifts, strict=True):
            one = (value >> shift) & 1 == 1
            s, lo, hi = level.rank(start), level.rank(low), level.rank(high)
            start = np.where(one, zeros + s, start - s)
            low = np.where(one, zeros + lo, low - lo)
            high = np.where(one, zeros + hi, high - hi)
        return low - start, high - start


class FMIndex:
    """Over ``text``, numbers from 0 (the separator) to ``most``. It starts with a separator, whose row stands for the end. ``piece``: a number for each place."""

    def __init__(self, text: np.ndarray, most: int, depth: int, piece: np.ndarray):
        n = len(text)
        if n and text[0]:
            raise ValueError("the text does not start with a separator")
        order = text.astype(np.int64)
        span = 1
        while True:  # rank places by 1, 2, 4, ... words
            index = np.argsort(order, kind="stable")
            in_order = order[index]
            new = np.concatenate([[0], np.cumsum(in_order[1:] != in_order[:-1])]) if n else np.empty(0, np.int64)
            del in_order, order
            if span >= depth or n and new[-1] == n - 1:
                break
            order = np.empty(n, np.int64)
            order[index] = new  # ranks
            del index, new
            behind = order[span:] + 1
            order *= n + 1
            order[: n - span] += behind
            del behind
            span *= 2
        del new
        index = index.astype(np.int32 if n < 1 << 31 else np.int64)
        self.depth, self.rows = depth, n
        self.piece = piece[index].astype(np.int32)
        self.first = np.searchsorted(text[index], np.arange(most + 2))
        self.bwt = WaveletMatrix(text[index - 1] if n else text, most)
        #: words that each row shares with the row before, up to ``depth``, not across separators
        self.common = np.zeros(n + 1, np.int8)
        alike = np.arange(1, n)
        for j in range(depth):
            a, b = index[alike] + j, index[alike - 1] + j
            alike, a, b = (x[(a < n) & (b < n)] for x in (alike, a, b))
            alike = alike[(text[a] == text[b]) & (text[a] != 0)]
            self.common[alike] += 1
        #: for a length: where rows that share so many words begin; made when it is first asked for
        self.groups: dict[int, np.ndarray] = {}

    def _widened(self, low: np.ndarray, high: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of all rows that share the first ``length`` words with the given ones."""
        low, high = low.copy(), high.copy()
        for d in np.unique(length).tolist():
            own = np.flatnonzero(length == d)
            if d == 0:
                low[own], high[own] = 0, self.rows
            else:
                if d not in self.groups:
                    self.groups[d] = np.flatnonzero(self.common < d).astype(np.int32)
                low[own] = self.groups[d][np.searchsorted(self.groups[d], low[own], "right") - 1]
                high[own] = self.groups[d][np.searchsorted(self.groups[d], high[own], "left")]
        return low, high

    def matching_statistics(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each place of the streams words[starts[k]:ends[k]]: the length of the longest match there, up to ``depth``, and the interval of its rows.

        Words are numbers of the index; -1 is a word that it does not hold. All streams go on together, a step at a time.
        """
        size = np.zeros(len(words), np.int8)
        lows, highs = np.zeros(len(words), np.int32), np.zeros(len(words), np.int32)
        low, high, length = np.zeros(len(starts), np.int64), np.full(len(starts), self.rows), np.zeros(len(starts), np.int64)
        at = ends - 1
        live = np.flatnonzero(at >= starts)
        while len(live):
            word = words[at[live]]
            known = np.maximum(word, 0)
            before, upto = self.bwt.ranks(known, low[live], high[live])
            met = (upto > before) & (word >= 0)
            go = live[met]
            low[go], high[go] = self.first[known[met]] + before[met], self.first[known[met]] + upto[met]
            length[go] += 1
            over = go[length[go] > self.depth]
            length[over] = self.depth
            low[over], high[over] = self._widened(low[over], high[over], length[over])
            stuck = live[~met]
            none = stuck[length[stuck] == 0]
            for k in (go, none):  # none: no row starts with this word
                size[at[k]], lows[at[k]], highs[at[k]] = length[k], low[k], high[k]
                at[k] -= 1
            short = stuck[length[stuck] > 0]
            short = short[at[short] >= starts[short]]
            length[short] = np.maximum(self.common[low[short]], self.common[high[short]])
            low[short], high[short] = self._widened(low[short], high[short], length[short])
            live = live[at[live] >= starts[live]]
        return size, lows, highs
