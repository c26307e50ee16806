"""FM-index of one shard: backward search by wavelet-tree ranks, location by sampled suffixes."""

from __future__ import annotations

import numpy as np

from .text import each_in


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Positions of ``seq`` in the order of their suffixes. Only suffixes that are still tied
    are sorted again, each time by two or three times the symbols."""
    n = len(seq)
    bits = max(n, int(seq.max()) + 1).bit_length()
    parts = 3 if 3 * bits <= 63 else 2
    rank, order, slots, reach = seq.astype(np.int64), np.arange(n), np.arange(n), 1
    while True:
        rows = order[slots]
        key = rank[rows]
        for step in range(1, parts):
            ahead = rows + step * reach
            key = (key << bits) | np.where(ahead < n, rank[np.minimum(ahead, n - 1)], 0)
        by = np.argsort(key)
        order[slots] = rows = rows[by]
        key = key[by]
        new = np.ones(len(rows), bool)
        new[1:] = key[1:] != key[:-1]
        first = slots[np.flatnonzero(new)]
        sizes = np.diff(np.append(np.flatnonzero(new), len(rows)))
        rank[rows] = np.repeat(first, sizes)
        reach *= parts
        slots = slots[np.repeat(sizes > 1, sizes)]
        if not len(slots):
            return order


class WaveletTree:
    """Ranks of symbols below ``2**levels``; each level keeps its zeros before its ones."""

    def __init__(self, seq: np.ndarray, levels: int):
        self.levels = levels
        self.zeros = []
        for level in reversed(range(levels)):
            one = (seq >> level & 1).astype(bool)
            before = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(~one, out=before[1:])
            self.zeros.append(before)
            seq = np.concatenate([seq[~one], seq[one]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each row, plus the symbol's own first place."""
        for level, before in zip(reversed(range(self.levels)), self.zeros):
            zeros = before[at]
            at = np.where(symbol >> level & 1, before[-1] + at - zeros, zeros)
        return at

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for before in self.zeros:
            zeros = before[at]
            one = before[at + 1] == zeros
            out = out << 1 | one
            at = np.where(one, before[-1] + at - zeros, zeros)
        return out


class FmIndex:
    """Index of a symbol array that ends with its only 0; symbols are below ``sigma``."""

    def __init__(self, seq: np.ndarray, sigma: int, sample: int = 16):
        order = suffix_order(seq)
        self.tree = WaveletTree(seq[order - 1], max(1, (sigma - 1).bit_length()))
        self.before = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=sigma))))
        self.origin = self.tree.rank(np.arange(sigma), np.zeros(sigma, np.int64))
        sampled = order % sample == 0
        self.sampled = np.concatenate(([0], np.cumsum(sampled)))
        self.places = order[sampled]

    def _back(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.tree.rank(symbol, at) - self.origin[symbol]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals [lo, hi) of patterns, which are aligned to the right of their rows."""
        width = patterns.shape[1]
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), int(self.before[-1]))
        live = np.arange(len(patterns))
        for step in range(width):
            live = live[(lengths[live] > step) & (lo[live] < hi[live])]
            if not len(live):
                break
            symbol = patterns[live, width - 1 - step]
            if step == 0:
                lo[live], hi[live] = self.before[symbol], self.before[symbol + 1]
            else:
                lo[live], hi[live] = self._back(symbol, lo[live]), self._back(symbol, hi[live])
        return lo, hi

    def locate(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, position) of every occurrence in the intervals."""
        sizes = np.maximum(hi - lo, 0)
        pattern, row = np.repeat(np.arange(len(lo)), sizes), each_in(lo, sizes)
        place, steps = np.full(len(row), -1), np.zeros(len(row), np.int64)
        todo = np.arange(len(row))
        while len(todo):
            known = self.sampled[row[todo] + 1] > self.sampled[row[todo]]
            done = todo[known]
            place[done] = self.places[self.sampled[row[done]]] + steps[done]
            todo = todo[~known]
            symbol = self.tree.symbol(row[todo])
            row[todo] = self._back(symbol, row[todo])
            steps[todo] += 1
        return pattern, place
