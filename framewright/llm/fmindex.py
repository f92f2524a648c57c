"""An FM-index over sequences of numbers, by numpy: wavelet ranks, backward search and sampled suffix positions.

The text is a row of runs, each ended by a sentinel. Sentinels are smaller than all symbols and each is smaller than those after it, so that no comparison of suffixes passes
a run's end and every step from a suffix to the one before it is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SAMPLE = 32
BATCH = 1 << 20


class BitRanks:
    """A row of bits with the number of ones before any place: 64-bit words and a count for each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.ones = int(bits.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """The ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class Wavelet:
    """A wavelet tree of numbers, stored by levels from the highest bit; zeros of a level stand before its ones."""

    def __init__(self, values: np.ndarray, bits: int):
        self.n, self.bits, self.levels = len(values), bits, []
        for level in range(bits - 1, -1, -1):
            ones = (values >> level) & 1 == 1
            self.levels.append(BitRanks(ones))
            values = np.concatenate([values[~ones], values[ones]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        low, high = np.zeros_like(at), at.copy()
        for k, level in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - k)) & 1 == 1
            zeros = self.n - level.ones
            low1, high1 = level.rank(low), level.rank(high)
            low, high = np.where(one, zeros + low1, low - low1), np.where(one, zeros + high1, high - high1)
        return high - low

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it stands before."""
        symbol, low, place = np.zeros_like(at), np.zeros_like(at), at.copy()
        for level in self.levels:
            one = level.get(place)
            zeros = self.n - level.ones
            low1, place1 = level.rank(low), level.rank(place)
            low, place = np.where(one, zeros + low1, low - low1), np.where(one, zeros + place1, place - place1)
            symbol = 2 * symbol + one
        return symbol, place - low


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffixes of a text in order, by doubling the length that ranks tell apart; 0 is a sentinel. Only ties are sorted again."""
    n = len(text)
    ends = text == 0
    key = text.astype(np.int64) + int(ends.sum())
    key[ends] = np.arange(int(ends.sum()))
    order = np.argsort(key, kind="stable")
    ranks = np.empty(n, np.int64)
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ranks[order] = first
    step = 1
    while True:
        single = new.copy()
        single[:-1] &= new[1:]
        tied = np.flatnonzero(~single)
        if not len(tied):
            return order
        items = order[tied]
        group, after = ranks[items], ranks[items + step]  # a tied suffix does not reach its run's end within step symbols
        within = np.lexsort((after, group))
        items, group, after = items[within], group[within], after[within]
        order[tied] = items
        fresh = np.ones(len(items), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        new[tied] = fresh
        at = np.maximum.accumulate(np.where(fresh, tied, 0))
        ranks[items] = at
        step *= 2


class FMIndex:
    """text: symbols from 1 on, 0 as sentinel at each run's end (the last value too)."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = SAMPLE):
        self.n, self.symbols = len(text), symbols
        order = suffix_order(text)
        before = text[order - 1]  # the first suffix's predecessor is the last sentinel
        self.wavelet = Wavelet(before.astype(np.int64), max(1, int(symbols).bit_length()))
        self.smaller = np.zeros(symbols + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=symbols + 1), out=self.smaller[1:])
        kept = (order % sample == 0) | (before == 0)  # no step leads from a run's start
        self.sampled, self.places = BitRanks(kept), order[kept]

    def ranges(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all patterns (rows, padded at the left, of `lengths` symbols): the rows [low, high) of suffixes that start with each."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        width = patterns.shape[1]
        for k in range(width - 1, -1, -1):
            live = live[(lengths[live] >= width - k) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = patterns[live, k]
            low[live] = self.smaller[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.smaller[symbol] + self.wavelet.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Batches of (pattern, text place) of all rows in the ranges."""
        counts = high - low
        total = np.concatenate([[0], np.cumsum(counts)])
        for start in range(0, int(total[-1]), BATCH):
            flat = np.arange(start, min(start + BATCH, int(total[-1])))
            pattern = np.searchsorted(total, flat, "right") - 1
            yield pattern, self.positions(low[pattern] + flat - total[pattern])

    def positions(self, rows: np.ndarray) -> np.ndarray:
        """Walk from each row to the suffix before until a sampled one is met."""
        out, rows, live, steps = np.empty(len(rows), np.int64), rows.copy(), np.arange(len(rows)), 0
        while len(live):
            met = self.sampled.get(rows[live])
            found = live[met]
            out[found] = self.places[self.sampled.rank(rows[found])] + steps
            live = live[~met]
            symbol, seen = self.wavelet.access(rows[live])
            rows[live] = self.smaller[symbol] + seen
            steps += 1
        return out
