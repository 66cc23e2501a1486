"""An FM-index over short word sequences, with a wavelet matrix for rank, in NumPy.

Symbols are small integers; sequences are joined by 0.  Suffixes are sorted by
their first ``DEPTH`` symbols (prefix doubling), which makes backward search
exact for patterns up to that length.  The transform's symbols are kept as a
wavelet matrix: one bit vector a level, packed in 64-bit words with a running
count a word (about 1.5 bits a symbol and level), so rank is a table look-up
and a population count.  Searches run over many patterns at once.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64


class FMIndex:
    def __init__(self, sequences: list[np.ndarray], weights: np.ndarray):
        lengths = np.array([len(s) for s in sequences], np.int64)
        self._build(np.concatenate([*sequences, np.zeros(0, np.int64)]), lengths, weights)

    @classmethod
    def of(cls, symbols: np.ndarray, lengths: np.ndarray, weights: np.ndarray) -> FMIndex:
        """An index of sequences that stand one after the other in ``symbols``."""
        self = cls.__new__(cls)
        self._build(symbols, lengths, weights)
        return self

    def _build(self, symbols: np.ndarray, lengths: np.ndarray, weights: np.ndarray) -> None:
        m = len(lengths)
        self.n = n = len(symbols) + m
        text = np.zeros(n, np.int64)
        text[np.arange(len(symbols)) + np.repeat(np.arange(m), lengths)] = symbols
        self.starts = np.cumsum(lengths + 1) - (lengths + 1)
        self.lengths, self.text = lengths, text
        self.sigma = int(text.max(initial=0)) + 1
        order = self._sort_suffixes()
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))])
        self._wavelet(text[order - 1])
        owner = np.repeat(np.arange(m), lengths + 1)
        self.weight = np.concatenate([[0], np.cumsum(np.asarray(weights, np.int64)[owner[order]])])
        self._common_prefixes(order)

    def _sort_suffixes(self) -> np.ndarray:
        """Rows by their first DEPTH symbols; what is equal that far may stand in any order."""
        rank, step, self._ranks = self.text, 1, [(1, self.text)]
        order = np.arange(self.n)
        while step < DEPTH:
            key = rank * (int(rank.max(initial=0)) + 2)
            key[:self.n - step] += rank[step:] + 1
            order = np.argsort(key)
            key = key[order]
            new = np.zeros(self.n, np.int64)
            new[1:] = np.cumsum(key[1:] != key[:-1])
            rank = np.empty(self.n, np.int64)
            rank[order] = new
            step *= 2
            self._ranks.append((step, rank))
            if self.n and new[-1] == self.n - 1:
                break
        return order

    def _common_prefixes(self, order: np.ndarray) -> None:
        """lcp[i]: common prefix of rows i - 1 and i, up to DEPTH; -1 at the borders; with minima over 2**k rows."""
        lcp = np.zeros(self.n + 1, np.int64)
        if self.n > 1:
            a, b, got = order[:-1].copy(), order[1:].copy(), np.zeros(self.n - 1, np.int64)
            for step, rank in reversed(self._ranks):
                same = (a < self.n) & (b < self.n)
                same &= rank[np.minimum(a, self.n - 1)] == rank[np.minimum(b, self.n - 1)]
                got += step * same
                a += step * same
                b += step * same
            lcp[1:-1] = np.minimum(got, DEPTH)
        lcp[0] = lcp[-1] = -1
        del self._ranks
        self.minima = [lcp.astype(np.int8)]
        k = 1
        while 2 * k <= self.n + 1:
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-k], last[k:]))
            k *= 2

    def _wavelet(self, symbols: np.ndarray) -> None:
        self.levels = max(1, int(self.sigma - 1).bit_length())
        words = (self.n >> 6) + 2
        self.bits, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = ((symbols >> level) & 1).astype(np.uint8)
            padded = np.zeros(words * 64, np.uint8)
            padded[:self.n] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed))])[:-1].astype(np.int32))
            self.zeros.append(self.n - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        every = np.arange(self.sigma)
        self.begin = self._walk(every, np.zeros(self.sigma, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[k][word] + np.bitwise_count(self.bits[k][word] & below)
            at = np.where((symbol >> (self.levels - 1 - k)) & 1, self.zeros[k] + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``symbol + pattern`` from the rows [lo, hi) of each pattern."""
        both = self._walk(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        shift = self.first[symbol] - self.begin[symbol]
        m = len(symbol)
        return both[:m] + shift, both[m:] + shift

    def widen(self, lo: np.ndarray, hi: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that share the first ``length`` symbols with the rows [lo, hi)."""
        lo, hi = lo.copy(), hi.copy()
        for k in range(len(self.minima) - 1, -1, -1):
            low, step = self.minima[k], 1 << k
            at = lo - step + 1
            go = (at >= 0) & (low[np.clip(at, 0, len(low) - 1)] >= length)
            lo -= step * go
            go = (hi + step <= self.n + 1) & (low[np.clip(hi, 0, len(low) - 1)] >= length)
            hi += step * go
        return lo, hi

    def repeated(self, size: int, least: int = 2) -> list[np.ndarray]:
        """Per sequence the starts of its runs of ``size`` symbols whose weighted number of occurrences is ``least`` or more."""
        owner, start = self.repeated_runs(size, least)
        return np.split(start, np.searchsorted(owner, np.arange(1, len(self.starts)))) if len(self.starts) else []

    def repeated_runs(self, size: int, least: int = 2) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, start) of every such run, in order.

        Matching statistics from right to left: each step prepends the next
        symbol; if too few occurrences are left, the match is cut from the
        right to its longest prefix that more rows share, and the step is tried again.
        """
        if size >= DEPTH:
            raise ValueError(f"size must be below {DEPTH}")
        m = len(self.starts)
        lo, hi, length = np.zeros(m, np.int64), np.full(m, self.n, np.int64), np.zeros(m, np.int64)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        lcp = self.minima[0]
        for back in range(1, int(self.lengths.max(initial=0)) + 1):
            live = np.flatnonzero(self.lengths >= back)
            # what can no longer complete a run needs no more steps
            place = self.starts[live] + self.lengths[live] - back
            symbol = self.text[place]
            long = live[length[live] >= DEPTH - 1]
            if len(long):
                lo[long], hi[long] = self.widen(lo[long], hi[long], np.full(len(long), size))
                length[long] = size
            while len(live):
                a, b = self.extend(symbol, lo[live], hi[live])
                enough = self.weight[b] - self.weight[a] >= least
                ok = live[enough]
                lo[ok], hi[ok] = a[enough], b[enough]
                length[ok] += 1
                live, symbol = live[~enough], symbol[~enough]
                none = length[live] == 0
                live, symbol = live[~none], symbol[~none]
                if len(live):
                    shorter = np.maximum(0, np.maximum(lcp[lo[live]], lcp[hi[live]]).astype(np.int64))
                    root = shorter == 0
                    wide = self.widen(lo[live], hi[live], np.maximum(shorter, 1))
                    lo[live] = np.where(root, 0, wide[0])
                    hi[live] = np.where(root, self.n, wide[1])
                    length[live] = shorter
            hit = np.flatnonzero((length >= size) & (self.lengths >= back))
            found.append((hit, self.lengths[hit] - back))
        owner, start = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((start, owner))
        return owner[order], start[order]
