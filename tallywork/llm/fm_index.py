"""An FM-index over a sequence of symbols, in numpy: suffix order, wavelet matrix, sampled suffix positions.

The sequence consists of segments, each closed by the symbol 0, which no phrase holds. All functions work on
arrays of phrases or places at once.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

RATE = 8  # every so many places of a segment, the first among them, the suffix position is kept


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. A 0 is less than any other symbol and than any later 0.

    Suffixes are ordered by their first few symbols, and what is still equal by twice as many, again and again.
    """
    n = len(symbols)
    ends = symbols == 0
    closed = int(ends.sum())
    rank = np.where(ends, np.cumsum(ends) - 1, symbols + (closed - 1)).astype(np.int64)
    bits = int(rank.max() + 1).bit_length()
    depth = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(depth):
        key <<= bits
        key[: max(n - k, 0)] += rank[k:] + 1
    order = np.argsort(key, kind="stable")
    open_ = _ranked(order, key[order], np.arange(n), rank)
    while len(open_):
        start = order[open_]
        beyond = start + depth
        key = (rank[start] << 32) + np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        order[open_] = start[by]
        open_ = _ranked(order, key[by], open_, rank)
        depth *= 2
    return order


def _ranked(order: np.ndarray, key: np.ndarray, slots: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Give each suffix in ``slots`` the slot where its run of equal keys begins; slots of runs of several."""
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(first)
    size = np.diff(starts, append=len(key))
    rank[order[slots]] = np.repeat(slots[starts], size)
    return slots[np.repeat(size > 1, size)]


class Bits(NamedTuple):
    """A row of bits with the number of ones before each block of 64."""

    words: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray) -> Bits:
        many = np.bitwise_count(words).astype(np.int64)
        return cls(words, np.concatenate([[0], np.cumsum(many)[:-1]]))

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones stand before each place."""
        block, rest = at >> 6, (at & 63).astype(np.uint64)
        return self.before[block] + np.bitwise_count(self.words[block] & ((np.uint64(1) << rest) - np.uint64(1)))

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def packed(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit numbers, one block more than needed, so that every place up to the end has its block."""
    blocks = len(bits) // 64 + 1
    raw = np.packbits(bits, bitorder="little")
    return np.concatenate([raw, np.zeros(blocks * 8 - len(raw), np.uint8)]).view("<u8")


class FmIndex:
    """``levels`` holds the packed bits of the wavelet matrix from the highest bit down, ``counts`` how often each
    symbol occurs, ``marks`` the rows with a kept suffix position and ``kept`` these positions."""

    def __init__(self, levels: np.ndarray, counts: np.ndarray, marks: np.ndarray, kept: np.ndarray):
        self.n = int(counts.sum())
        self.levels = [Bits.of(w) for w in levels]
        self.zeros = [self.n - int(b.ones(np.array([self.n]))[0]) for b in self.levels]
        self.less = np.cumsum(counts) - counts
        # the last level has the symbols in the order of their reversed bits
        flipped = np.zeros(len(counts), np.int64)
        for k in range(len(levels)):
            flipped |= ((np.arange(len(counts)) >> k) & 1) << (len(levels) - 1 - k)
        order = np.argsort(flipped)
        self.begin = np.empty(len(counts), np.int64)
        self.begin[order] = np.cumsum(counts[order]) - counts[order]
        self.marks, self.kept = Bits.of(marks), kept

    @staticmethod
    def parts(symbols: np.ndarray, entries: int) -> tuple[np.ndarray, ...]:
        """What the constructor takes, for a sequence of symbols below ``entries``."""
        n = len(symbols)
        order = suffix_order(symbols)
        row = symbols[order - 1].astype(np.int32)  # what stands before each suffix
        levels = []
        for k in reversed(range(max(1, (entries - 1).bit_length()))):
            bit = (row >> k) & 1 == 1
            levels.append(packed(bit))
            row = np.concatenate([row[~bit], row[bit]])
        heads = np.concatenate([[0], np.flatnonzero(symbols[:-1] == 0) + 1])
        place = np.arange(n) - np.repeat(heads, np.diff(heads, append=n))
        mark = (place % RATE == 0)[order]
        return np.stack(levels), np.bincount(symbols, minlength=entries), packed(mark), order[mark].astype(np.int32)

    def _before(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often a symbol stands in the rows before a place."""
        p = at
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = bits.ones(p)
            up = (symbol >> (len(self.levels) - 1 - k)) & 1 == 1
            p = np.where(up, zeros + ones, p - ones)
        return p - self.begin[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and end of the rows of suffixes that begin with each phrase (a row of symbols, none of them 0)."""
        first, end = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        going = np.arange(len(phrases))
        for j in reversed(range(phrases.shape[1])):
            if not len(going):
                break
            symbol = phrases[going, j]
            first[going] = self.less[symbol] + self._before(symbol, first[going])
            end[going] = self.less[symbol] + self._before(symbol, end[going])
            going = going[first[going] < end[going]]
        return first, np.maximum(first, end)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place in the sequence of the suffix in each row: a walk back to the nearest kept position."""
        out, steps = np.empty(len(rows), np.int64), 0
        going, p = np.arange(len(rows)), rows
        while len(going):
            found = self.marks.get(p)
            out[going[found]] = self.kept[self.marks.ones(p[found])] + steps
            going, p = going[~found], p[~found]
            symbol, q = np.zeros(len(p), np.int64), p
            for bits, zeros in zip(self.levels, self.zeros):
                up, ones = bits.get(q), bits.ones(q)
                symbol = symbol << 1 | up
                q = np.where(up, zeros + ones, q - ones)
            p = self.less[symbol] + q - self.begin[symbol]
            steps += 1
        return out
