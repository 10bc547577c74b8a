"""An FM-index over the words of a shard: wavelet-matrix ranks, backward
search, and location by sampled suffix positions. All queries are run for
many patterns at a time in numpy.
"""

from __future__ import annotations

import numpy as np

#: A suffix order packs two ranks and a position of 21 bits each into a key.
MOST = (1 << 21) - 2
_MASK = np.uint64((1 << 21) - 1)


def suffix_order(first: np.ndarray) -> np.ndarray:
    """The suffixes' order, by prefix doubling. ``first`` holds a rank for each
    position; the last position's rank must be unique."""
    n = len(first)
    place = np.arange(n, dtype=np.uint64)
    rank = first.astype(np.uint64)
    todo, h, whole = place, 0, True
    while len(todo):
        if whole and h == 0:
            key = np.sort(rank << np.uint64(42) | place)
        else:
            far = np.minimum(todo + np.uint64(h), np.uint64(n - 1)).astype(np.int64)
            key = np.sort(rank[todo.astype(np.int64)] << np.uint64(42) | rank[far] << np.uint64(21) | todo)
        who = (key & _MASK).astype(np.int64)
        pair, old = key >> np.uint64(21), key >> np.uint64(42)
        m = len(key)
        at = np.arange(m)
        new_pair = np.empty(m, bool)
        new_old = np.empty(m, bool)
        new_pair[0] = new_old[0] = True
        new_pair[1:] = pair[1:] != pair[:-1]
        new_old[1:] = old[1:] != old[:-1]
        pair_at = np.maximum.accumulate(np.where(new_pair, at, 0))
        if h == 0:
            fresh = pair_at  # ranks become places in the whole order
        else:
            old_at = np.maximum.accumulate(np.where(new_old, at, 0))
            fresh = old.astype(np.int64) + pair_at - old_at
        rank[who] = fresh.astype(np.uint64)
        alone = new_pair.copy()
        alone[:-1] &= new_pair[1:]
        todo = who[~alone].astype(np.uint64)
        h = max(1, h * 2)
    order = np.empty(n, np.int64)
    order[rank.astype(np.int64)] = np.arange(n)
    return order


class Bits:
    """A bit vector with ranks."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, bool)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        w = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Ranks of symbols: one bit vector for each bit of the symbols, highest first."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.depth = max(1, int(n_symbols - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        row = symbols.astype(np.uint32)
        for level in reversed(range(self.depth)):
            bit = (row >> np.uint32(level) & np.uint32(1)).astype(bool)
            self.levels.append((Bits(bit), len(row) - int(bit.sum())))
            row = np.concatenate([row[~bit], row[bit]])
        every = np.arange(n_symbols, dtype=np.int64)
        self.first = self._down(every, np.zeros(n_symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(self.levels):
            one = (symbol >> (self.depth - 1 - k) & 1).astype(bool)
            ones = bits.rank(at)
            at = np.where(one, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._down(symbol, at) - self.first[symbol]

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its occurrences before that place."""
        symbol = np.zeros(len(at), np.int64)
        for bits, zeros in self.levels:
            one = bits.get(at)
            ones = bits.rank(at)
            symbol = symbol << 1 | one
            at = np.where(one, zeros + ones, at - ones)
        return symbol, at - self.first[symbol]


class FMIndex:
    """Index of several texts of symbols 0 .. n_symbols - 1. Every text ends in
    a mark of its own, so no match runs over the end of a text."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, n_symbols: int, every: int = 16):
        texts = len(lengths)
        n = len(symbols) + texts
        if n > MOST or texts + n_symbols > MOST:
            raise ValueError("shard too large")
        ends = np.cumsum(lengths + 1) - 1  # places of the end marks
        self.starts = ends - lengths
        place = np.ones(n, bool)
        place[ends] = False
        ranks = np.empty(n, np.int64)
        ranks[ends] = np.arange(texts)
        ranks[place] = symbols + texts
        order = suffix_order(ranks)
        text = np.zeros(n, np.int64)
        text[place] = symbols + 1
        bwt = text[order - 1]  # 0: the row's suffix begins a text
        self.tree = WaveletMatrix(bwt, n_symbols + 1)
        self.less = np.zeros(n_symbols + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=n_symbols + 1), out=self.less[1:])
        sampled = (order % every == 0) | (bwt == 0)
        self.marks, self.samples = Bits(sampled), order[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of patterns (one a row, symbols) -> (pattern's row,
        first row of its suffixes, end) of those that occur."""
        who = np.arange(len(patterns))
        c = patterns[:, -1] + 1
        low, high = self.less[c], self.less[c + 1]
        for j in range(patterns.shape[1] - 2, -1, -1):
            live = low < high
            who, low, high = who[live], low[live], high[live]
            c = patterns[who, j] + 1
            low = self.less[c] + self.tree.rank(c, low)
            high = self.less[c] + self.tree.rank(c, high)
        live = low < high
        return who[live], low[live], high[live]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the shard of the suffixes at these rows: walk back to a
        sampled row and add the steps."""
        found = np.empty(len(rows), np.int64)
        who, steps = np.arange(len(rows)), 0
        while len(who):
            here = self.marks.get(rows)
            found[who[here]] = self.samples[self.marks.rank(rows[here])] + steps
            who, rows = who[~here], rows[~here]
            symbol, rank = self.tree.symbol_and_rank(rows)
            rows = self.less[symbol] + rank
            steps += 1
        return found
