"""An FM-index over a sequence of small integers: suffix order, wavelet tree, backward search, sampled positions.

All steps work on numpy arrays, and a search takes many phrases at once.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by prefix doubling. The sequence ends with a unique smallest symbol."""
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    n, span = len(symbols), 1
    while True:
        following = np.full(n, -1, dtype=np.int64)
        following[: n - span] = rank[span:] if span < n else rank[:0]
        pair = rank * (n + 1) + following + 1
        order = np.argsort(pair, kind="stable")
        sorted_pair = pair[order]
        fresh = np.empty(n, dtype=np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(sorted_pair[1:] != sorted_pair[:-1])])
        rank = fresh
        if rank.max() == n - 1 or span >= n:
            return order
        span *= 2


class WaveletTree:
    """Levels of bits, most significant first, with the number of ones before every place."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in reversed(range(bits)):
            bit = (values >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(len(values) - int(bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        begin, end = np.zeros_like(place), place.copy()
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            high = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            begin = np.where(high, zeros + ones[begin], begin - ones[begin])
            end = np.where(high, zeros + ones[end], end - ones[end])
        return end - begin

    def at(self, place: np.ndarray) -> np.ndarray:
        """The symbols at the places."""
        out, place = np.zeros_like(place), place.copy()
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            high = ones[place + 1] > ones[place]
            out = out * 2 + high
            place = np.where(high, zeros + ones[place], place - ones[place])
        return out


class FMIndex:
    """Index of a sequence of integers from 1; 0 is taken for its end."""

    def __init__(self, symbols: np.ndarray, sample: int = 8):
        text = np.concatenate([symbols.astype(np.int64), [0]])
        self.size = len(text)
        self.order_size = int(text.max()) + 1
        order = suffix_order(text)
        last = text[order - 1]
        self.tree = WaveletTree(last, max(1, int(self.order_size - 1).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.order_size))])
        self.sampled = np.where(order % sample == 0, order, -1)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the suffixes that begin with each phrase; phrases are rows, filled at the left end with -1."""
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.size, dtype=np.int64)
        for step in range(phrases.shape[1]):
            symbol = phrases[:, phrases.shape[1] - 1 - step]
            on = np.flatnonzero((step < lengths) & (low < high) & (symbol >= 0))
            if not len(on):
                break
            known = symbol[on] < self.order_size
            high[on[~known]] = low[on[~known]]
            on = on[known]
            base = self.before[symbol[on]]
            low[on], high[on] = base + self.tree.rank(symbol[on], low[on]), base + self.tree.rank(symbol[on], high[on])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: walk back to a sampled one, counting the steps."""
        rows, out, steps = rows.copy(), np.full(len(rows), -1, dtype=np.int64), 0
        left = np.arange(len(rows))
        while len(left):
            found = self.sampled[rows[left]]
            out[left[found >= 0]] = found[found >= 0] + steps
            left = left[found < 0]
            symbol = self.tree.at(rows[left])
            rows[left] = self.before[symbol] + self.tree.rank(symbol, rows[left])
            steps += 1
        return out
