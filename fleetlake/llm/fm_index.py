"""Compressed FM-index over integer sequences, searched many patterns at once.

The text is a list of segments of symbols; symbol 0 ends each segment.  Suffixes
are ordered by their first 64 symbols, which makes every interval of a pattern
of up to 64 symbols exact.  The transform is held as a wavelet tree (one bit
vector for each bit of the symbols, 64-bit words with block counts).
"""

from __future__ import annotations

import numpy as np

from fleetlake.llm.common import U64

DEPTH = 64


class Bits:
    """A bit vector with rank."""

    def __init__(self, flags: np.ndarray):
        packed = np.packbits(flags, bitorder="little")
        self.words = np.pad(packed, (0, -len(packed) % 8 + 8)).view(np.uint64)
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        w = i >> 6
        mask = (U64(1) << (i & 63).astype(np.uint64)) - U64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class WaveletTree:
    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels, self.zeros = [], []
        self.depth = max(1, int(sigma - 1).bit_length())
        now = symbols
        for level in range(self.depth - 1, -1, -1):
            bit = (now >> level) & 1 == 1
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(now) - bit.sum()))
            now = np.concatenate((now[~bit], now[bit]))
        self.base = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, bits in enumerate(self.levels):
            ones = bits.rank(i)
            i = np.where((c >> (self.depth - 1 - k)) & 1, self.zeros[k] + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol c before position i."""
        return self._down(c, i) - self.base[c]


class FMIndex:
    def __init__(self, segments: list[np.ndarray], sigma: int, length: int):
        """``segments``: arrays of symbols 1..sigma-1; ``length``: the threshold, at most 64."""
        assert length <= DEPTH
        sizes = np.array([len(s) + 1 for s in segments], np.int64)
        text = np.zeros(int(sizes.sum()), np.int64)
        ends = np.cumsum(sizes)
        inner = np.ones(len(text), bool)
        inner[ends - 1] = False
        text[inner] = np.concatenate(segments)
        self.n, self.length = len(text), length
        self.segment = np.repeat(np.arange(len(segments)), sizes)
        rank, self.ranks = text.copy(), {}
        h = 1
        while True:
            self.ranks[h] = rank.astype(np.int32)
            if h >= DEPTH:
                break
            key = rank * (self.n + sigma + 1) + np.concatenate((rank[h:] + 1, np.zeros(min(h, self.n), np.int64)))[:self.n]
            order = np.argsort(key, kind="stable")
            step = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
            rank = np.empty(self.n, np.int64)
            rank[order] = step
            h *= 2
        self.sa = order
        below = np.bincount(text, minlength=sigma)
        self.less = np.cumsum(below) - below
        self.tree = WaveletTree(text[order - 1], sigma)
        # lcp[i]: common symbols of suffixes i-1 and i, up to 64; -1 at both ends
        a, b = order[:-1].copy(), order[1:].copy()
        lcp = np.zeros(self.n - 1, np.int64)
        for h in (64, 32, 16, 8, 4, 2, 1):
            ok = (a + h <= self.n) & (b + h <= self.n)
            same = np.zeros(len(a), bool)
            same[ok] = self.ranks[h][a[ok]] == self.ranks[h][b[ok]]
            lcp += h * same
            a, b = np.minimum(a + h * same, self.n), np.minimum(b + h * same, self.n)
        self.lcp = np.concatenate(([-1], lcp, [-1]))
        del self.ranks
        edge = np.flatnonzero(self.lcp[:-1] < length)
        self.class_of = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, self.n)))
        self.class_start, self.class_end = edge, np.append(edge[1:], self.n)

    def least(self, value: np.ndarray) -> np.ndarray:
        """For each class of suffixes that agree on ``length`` symbols, the least
        value among the segments they start in."""
        return np.minimum.reduceat(value[self.segment[self.sa]], self.class_start)

    def _shrink(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Widen intervals, in place, to the nearest shorter match; returns its length."""
        d = np.maximum(self.lcp[lo], self.lcp[hi])
        whole = d <= 0
        lo[whole], hi[whole] = 0, self.n
        for bound, step in ((lo, -1), (hi, 1)):
            move = np.flatnonzero(~whole & (self.lcp[bound] >= d))
            while len(move):
                bound[move] += step
                move = move[self.lcp[bound[move]] >= d[move]]
        return np.maximum(d, 0)

    def matching(self, queries: list[np.ndarray]):
        """Backward search of all queries at once, from their last symbol.

        Yields (query numbers, start, matched, class): for each query the match
        that starts at ``start`` has ``matched`` symbols (at most ``length``) in
        the index; ``class`` is that of its suffixes where the threshold is met,
        else -1.  Unknown symbols are 0."""
        size = np.array([len(q) for q in queries], np.int64)
        order = np.argsort(-size, kind="stable")
        size = size[order]
        flat = np.concatenate([queries[i] for i in order])
        end = np.cumsum(size)
        lo, hi, got = np.zeros(len(order), np.int64), np.full(len(order), self.n), np.zeros(len(order), np.int64)
        for step in range(int(size[0]) if len(size) else 0):
            m = int(np.searchsorted(-size, -step, side="left"))  # queries longer than step
            c = flat[end[:m] - 1 - step]
            a, b, k = lo[:m], hi[:m], got[:m]
            todo = np.arange(m)
            while len(todo):
                both = self.less[np.tile(c[todo], 2)] + self.tree.rank(np.tile(c[todo], 2), np.concatenate((a[todo], b[todo])))
                x, y = both[:len(todo)], both[len(todo):]
                hit = (y > x) & (c[todo] > 0)
                good = todo[hit]
                a[good], b[good] = x[hit], y[hit]
                k[good] += 1
                fail = todo[~hit]
                dead = fail[k[fail] == 0]
                a[dead], b[dead] = 0, self.n
                todo = fail[k[fail] > 0]
                if len(todo):
                    s, e = a[todo], b[todo]
                    k[todo] = self._shrink(s, e)
                    a[todo], b[todo] = s, e
            full = np.flatnonzero(k >= self.length)
            cls = np.full(m, -1, np.int64)
            cls[full] = self.class_of[a[full]]
            a[full], b[full], k[full] = self.class_start[cls[full]], self.class_end[cls[full]], self.length
            yield order[:m], size[:m] - 1 - step, k.copy(), cls
