"""FM-index over the word ids of one shard of texts, in numpy.

The indexed sequence is made of runs of word ids (1 and up), each closed by
a separator (0).  Separators sort before all ids and by position, so every
suffix is unique after its run's end.  Ranks come from a wavelet tree (in
its level-wise, matrix form); positions from sampled suffix positions: every
``SAMPLE``-th id of a run and every run start, reached by LF steps.
All methods work on arrays of queries at once.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Prefix doubling; each round sorts only suffixes that still tie."""
    n = len(seq)
    seps = seq == 0
    first = seq.astype(np.int64) + int(seps.sum())
    first[seps] = np.arange(int(seps.sum()))
    sa = np.argsort(first, kind="stable")
    ordered = first[sa]
    begins = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    slots = np.arange(n)
    depth = 1
    while True:
        r = rank[sa[slots]]
        same = r[1:] == r[:-1]
        tied = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        slots = slots[tied]
        if not len(slots):
            return sa
        items = sa[slots]
        # a tied suffix holds no separator in its first `depth` ids, so it goes on
        a, b = rank[items], rank[items + depth]
        order = np.lexsort((b, a))
        items, a, b = items[order], a[order], b[order]
        sa[slots] = items
        begins = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        rank[items] = slots[np.maximum.accumulate(np.where(begins, np.arange(len(slots)), 0))]
        depth *= 2


class WaveletTree:
    """Occurrences of a symbol before a place, for arrays of both."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.bits, self.below, self.zeros = [], [], []
        seq = seq.astype(np.int64)
        for level in reversed(range(self.levels)):
            bit = ((seq >> level) & 1).astype(bool)
            padded = np.zeros((len(bit) // 64 + 1) * 64, bool)
            padded[:len(bit)] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.below.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]))
            self.zeros.append(int(len(bit) - bit.sum()))
            seq = np.concatenate([seq[~bit], seq[bit]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.below[level][block] + np.bitwise_count(self.bits[level][block] & mask)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(at), at
        for k in range(self.levels):
            one = ((symbol >> (self.levels - 1 - k)) & 1).astype(bool)
            ones_low, ones_high = self._ones(k, low), self._ones(k, high)
            low = np.where(one, self.zeros[k] + ones_low, low - ones_low)
            high = np.where(one, self.zeros[k] + ones_high, high - ones_high)
        return high - low


class FMIndex:
    def __init__(self, seq: np.ndarray, symbols: int):
        """``seq``: ids below ``symbols`` in runs, each closed by a 0."""
        n = len(seq)
        sa = suffix_array(seq)
        self.last = seq[sa - 1].astype(np.int64)         # symbol before each suffix
        self.last[sa == 0] = 0
        counts = np.bincount(seq, minlength=symbols + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.tree = WaveletTree(self.last, symbols)
        place = np.arange(n)
        run_start = np.maximum.accumulate(
            np.where(np.concatenate([[True], seq[:-1] == 0]), place, 0))
        self.sampled = ((place - run_start) % SAMPLE == 0)[sa]
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = sa[self.sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [low, high) of phrases given right-aligned."""
        width = phrases.shape[1]
        symbol = phrases[:, width - 1].astype(np.int64)
        low, high = self.first[symbol].copy(), self.first[symbol + 1].copy()
        for step in range(1, width):
            go = np.flatnonzero((lengths > step) & (high > low))
            if not len(go):
                break
            symbol = phrases[go, width - 1 - step].astype(np.int64)
            base = self.first[symbol]
            low[go], high[go] = (base + self.tree.rank(symbol, low[go]),
                                 base + self.tree.rank(symbol, high[go]))
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix row."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(~self.sampled[rows])
        while len(open_):
            at = rows[open_]
            symbol = self.last[at]
            rows[open_] = self.first[symbol] + self.tree.rank(symbol, at)
            steps[open_] += 1
            open_ = open_[~self.sampled[rows[open_]]]
        return self.samples[self.sample_rank[rows]] + steps
