"""A compressed full-text index over sequences of words: Burrows-Wheeler transform in
a wavelet matrix of packed bits, with backward search for many patterns at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector of packed 64-bit words with counts per word; rank in constant time."""

    def __init__(self, bits: np.ndarray):
        n = -(-(len(bits) + 1) // 64) * 64
        padded = np.zeros(n, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]))

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class Wavelet:
    """Occurrences of a symbol before a place, from one bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.width = max(1, int(top).bit_length())
        self.levels, self.zeros = [], []
        s = symbols
        for level in range(self.width - 1, -1, -1):
            bit = (s >> level) & 1
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate([s[bit == 0], s[bit == 1]])
        self.first = self._descend(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _descend(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            ones = bits.rank(i)
            i = np.where((c >> (self.width - 1 - k)) & 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._descend(c, i) - self.first[c]


class FMIndex:
    """Index of texts of words 1..top. ``values``: a number per text; each row of the index has its text's.

    ``depth`` is the length of the windows asked for: rows that agree in that many
    words are known beforehand, with the least value among them.
    """

    def __init__(self, texts: np.ndarray, sizes: np.ndarray, values: np.ndarray, top: int, depth: int):
        m, n = len(sizes), len(texts) + len(sizes)
        ends = np.cumsum(sizes + 1) - 1
        t = np.zeros(n, np.int64)
        own = np.ones(n, bool)
        own[ends] = False
        t[own] = texts
        # every text's end is a symbol of its own, smaller than all words
        rank = t + m - 1
        rank[ends] = np.arange(m)
        length, ranks = 1, {1: rank}
        while True:
            then = np.full(n, -1, np.int64)
            then[: n - length] = rank[length:]
            key = rank * (max(n, m + top) + 2) + then + 1
            sa = np.argsort(key, kind="stable")
            step = np.concatenate(([False], key[sa][1:] != key[sa][:-1]))
            rank = np.empty(n, np.int64)
            rank[sa] = np.cumsum(step)
            length *= 2
            ranks[length] = rank
            if rank[sa[-1]] == n - 1:
                break

        def agree(d: int) -> np.ndarray:
            """Where runs of rows with the same first d symbols begin."""
            new, at = np.zeros(n, bool), 0
            new[0] = True
            for k in (1 << b for b in range(d.bit_length() - 1, -1, -1) if d >> b & 1):
                r = np.append(ranks.get(k, rank), -np.arange(1, d + 1))[sa + at]
                new[1:] |= r[1:] != r[:-1]
                at += k
            return np.flatnonzero(new)

        self.n, self.depth = n, depth
        self.bwt = Wavelet(t[sa - 1], top)
        count = np.bincount(t, minlength=top + 1)
        self.before = m + np.cumsum(count) - count - count[0]  # rows that begin with a smaller symbol
        whole, shorter = agree(depth), agree(depth - 1)
        text = np.repeat(np.arange(m), sizes + 1)
        self.least = np.repeat(np.minimum.reduceat(values[text[sa]], whole), np.diff(np.append(whole, n)))
        run = np.diff(np.append(shorter, n))
        self.parent_lo, self.parent_hi = np.repeat(shorter, run), np.repeat(shorter + run, run)

    def _step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that begin with c and go on like the rows lo..hi."""
        both = self.bwt.rank(np.concatenate([c, c]), np.concatenate([lo, hi])) + np.tile(self.before[c], 2)
        return both[: len(c)], both[len(c) :]

    def _longest(self, texts: np.ndarray, at: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows and length of the longest match of at most ``most`` words from each place on."""
        lo, hi, got = np.zeros(len(at), np.int64), np.full(len(at), self.n, np.int64), np.zeros(len(at), np.int64)
        for j in range(int(most.max(initial=0)), 0, -1):
            todo = np.flatnonzero((got == 0) & (most >= j))
            a, b = np.zeros(len(todo), np.int64), np.full(len(todo), self.n, np.int64)
            for k in range(j - 1, -1, -1):
                a, b = self._step(texts[at[todo] + k], a, b)
            ok = a < b
            lo[todo[ok]], hi[todo[ok]], got[todo[ok]] = a[ok], b[ok], j
        return lo, hi, got

    def windows(self, texts: np.ndarray, sizes: np.ndarray, none: int) -> np.ndarray:
        """For each word of the texts, the least value among index rows that go on like it
        for ``depth`` words; ``none`` where nothing does or the text ends before.

        All texts go backwards together, longest first. Each word lengthens the match
        by a backward step, after dropping its last word once it has full length; where
        a step finds nothing, shorter matches from that word on are looked up.
        """
        out = np.full(len(texts), none, np.int64)
        order = np.argsort(-sizes, kind="stable")
        size, last = sizes[order], (np.cumsum(sizes) - 1)[order]
        if not len(size):
            return out
        lo, hi, got = np.zeros(len(size), np.int64), np.full(len(size), self.n, np.int64), np.zeros(len(size), np.int64)
        for s in range(int(size[0])):
            live = int(np.searchsorted(-size, -s, side="left"))
            lo, hi, got = lo[:live], hi[:live], got[:live]
            c = texts[last[:live] - s]
            full = got == self.depth
            if full.any():
                row = np.where(full, lo, 0)
                hi = np.where(full, self.parent_hi[row], hi)
                lo = np.where(full, self.parent_lo[row], lo)
                got = got - full
            lo, hi = self._step(c, lo, hi)
            got = got + 1
            lost = np.flatnonzero(lo >= hi)
            if len(lost):
                lo[lost], hi[lost], got[lost] = self._longest(texts, last[:live][lost] - s, got[lost] - 1)
            found = got == self.depth
            out[(last[:live] - s)[found]] = self.least[lo[found]]
        return out
