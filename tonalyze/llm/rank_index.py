"""A learned rank index: piecewise-linear, error-bounded, exact.

Increasing offsets y[0..n] are approximated by line segments.  A segment
starts on its first offset and grows while one slope keeps all its offsets
within ``error`` (a cone of slopes that narrows with every offset).  What
the line misses is stored per rank as a small residual, so that
``offset(rank)`` is the prediction plus the residual: exact for every rank.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class RankIndex:
    first: np.ndarray      # first rank of each segment
    start: np.ndarray      # its offset there
    slope: np.ndarray
    residual: np.ndarray   # by rank

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, ranks, side="right") - 1
        return self.start[at] + np.rint(self.slope[at] * (ranks - self.first[at])).astype(np.int64)

    def offset(self, ranks: np.ndarray) -> np.ndarray:
        return self.predict(ranks) + self.residual[ranks]


def _segment(y: np.ndarray, s: int, error: int) -> tuple[int, float]:
    """(first rank past the segment that starts at rank s, its slope)."""
    low, high, end, step = -np.inf, np.inf, s + 1, 128
    while end < len(y):
        ahead = y[end:end + step] - y[s]
        x = np.arange(end - s, end - s + len(ahead))
        lows = np.maximum(low, np.maximum.accumulate((ahead - error) / x))
        highs = np.minimum(high, np.minimum.accumulate((ahead + error) / x))
        empty = lows > highs
        k = int(empty.argmax()) if empty[-1] else len(empty)     # the cone only narrows
        if k:
            low, high = lows[k - 1], highs[k - 1]
        end += k
        if k < len(empty):
            break
        step *= 2
    return end, 0.0 if end == s + 1 else (low + high) / 2


def fit(y: np.ndarray, error: int) -> RankIndex:
    """Index of the offsets ``y`` (increasing integers, at least one)."""
    first, slope, s = [], [], 0
    while s < len(y):
        first.append(s)
        s, m = _segment(y, s, error)
        slope.append(m)
    index = RankIndex(np.array(first), y[first], np.array(slope), np.zeros(0, np.int64))
    missed = y - index.predict(np.arange(len(y)))
    small = np.int16 if len(missed) and np.abs(missed).max() < 32768 else np.int64
    return RankIndex(index.first, index.start, index.slope, missed.astype(small))
