"""A compressed full-text index of many short texts: BWT in a wavelet matrix, suffix array, LCP; in numpy.

All searches run in lock step over many patterns, so the work per step is a few array operations per wavelet level."""

from __future__ import annotations

import numpy as np


class Bits:
    """Bits packed 64 to a word with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        pad = (-len(bits)) % 64 + 64
        self.words = np.packbits(np.concatenate([bits, np.zeros(pad, bits.dtype)]).astype(np.uint8), bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]]).astype(np.int32)
        self.zeros = int(len(bits) - bits.sum())

    def rank1(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class FMIndex:
    """texts: arrays of code points; owner: whose each text is. Separators (symbol 0) never take part in a match."""

    def __init__(self, texts: list[np.ndarray], owner: np.ndarray):
        self.lengths = np.array([len(t) for t in texts])
        self.alphabet = np.unique(np.concatenate(texts))
        n = int(self.lengths.sum()) + len(texts)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + 1)[:-1]])
        s = np.zeros(n, np.int64)
        for t, at in zip(texts, self.starts):
            s[at : at + len(t)] = np.searchsorted(self.alphabet, t) + 1
        self.n, self.s = n, s
        text_of = np.repeat(np.arange(len(texts)), self.lengths + 1)
        left = self.starts[text_of] + self.lengths[text_of] - np.arange(n)  # characters before the next separator
        self._sort(int(self.lengths.max()), left)
        self.doc = owner[text_of][self.sa]
        self.changes = np.concatenate([[0], np.cumsum(self.doc[1:] != self.doc[:-1])])
        self._wavelet()
        self._parents()

    def _sort(self, depth: int, left: np.ndarray) -> None:
        """Suffix order as far as ``depth`` by prefix doubling; LCP from the ranks of each level."""
        n, bits = self.n, int(len(self.alphabet)).bit_length()
        size = max(1, 62 // bits)
        key = np.zeros(n, np.int64)
        for k in range(size):
            key[: n - k] |= self.s[k:] << (bits * (size - 1 - k))
        levels = []
        while True:
            order = np.argsort(key, kind="stable")
            sorted_ = key[order]
            r = np.zeros(n + 1, np.int64)
            r[order] = np.cumsum(np.concatenate([[1], sorted_[1:] != sorted_[:-1]]))
            levels.append((size, r.astype(np.int32)))
            if size >= depth or r.max() == n:
                break
            nxt = np.zeros(n, np.int64)
            nxt[: max(0, n - size)] = r[size:n]
            key = r[:n] * (n + 1) + nxt
            size *= 2
        self.sa = order
        a, b = order[:-1], order[1:]
        lcp = np.zeros(n - 1, np.int64)
        for size, r in reversed(levels):
            pa, pb = np.minimum(a + lcp, n), np.minimum(b + lcp, n)
            same = (r[pa] == r[pb]) & (pa < n) & (pb < n)
            lcp[same] += size
        for _ in range(levels[0][0]):
            pa, pb = np.minimum(a + lcp, n - 1), np.minimum(b + lcp, n - 1)
            lcp[(self.s[pa] == self.s[pb]) & (a + lcp < n) & (b + lcp < n)] += 1
        lcp = np.minimum(lcp, np.minimum(left[a], left[b]))
        self.lcp = np.concatenate([[-1], lcp, [-1]])

    def _wavelet(self) -> None:
        bwt = self.s[self.sa - 1]  # what stands before each suffix
        sigma = len(self.alphabet) + 1
        counts = np.bincount(self.s, minlength=sigma)
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.levels = []
        cur = bwt
        depth = int(sigma - 1).bit_length()
        for k in range(depth - 1, -1, -1):
            bit = (cur >> k) & 1
            b = Bits(bit)
            self.levels.append((k, b))
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])
        symbols = np.arange(sigma)
        self.origin = np.zeros(sigma, np.int64)
        self.origin = self._down(symbols, np.zeros(sigma, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, b in self.levels:
            one = b.rank1(i)
            i = np.where((c >> k) & 1, b.zeros + one, i - one)
        return i

    def step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the intervals of c + pattern."""
        both = self._down(np.concatenate([c, c]), np.concatenate([lo, hi]))
        base = self.first[c] - self.origin[c]
        return base + both[: len(c)], base + both[len(c) :]

    def _parents(self) -> None:
        """For each LCP entry the nearest smaller ones on either side."""
        lcp = self.lcp.tolist()
        before, after, stack = [0] * len(lcp), [len(lcp) - 1] * len(lcp), [0]
        for i in range(1, len(lcp)):
            v = lcp[i]
            while lcp[stack[-1]] > v:
                after[stack.pop()] = i
            top = stack[-1]
            before[i] = before[top] if lcp[top] == v else top
            stack.append(i)
        self.before, self.after = np.array(before), np.array(after)

    def matching(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of the indexed texts against the texts of other owners, where they reach ``least``.

        (text, position, length, row): the longest stretch from that position that some other owner's text has too, and
        a row of the suffix array in its interval. Texts are streamed right to left, all at once: a step extends the
        match by one character, or first gives up characters at its right end (the parent interval) until it can."""
        order = np.argsort(-self.lengths, kind="stable")
        lens = self.lengths[order]
        lo, hi, ln = np.zeros(len(order), np.int64), np.full(len(order), self.n), np.zeros(len(order), np.int64)
        found = []
        for t in range(int(lens[0]) if len(lens) else 0):
            live = int(np.searchsorted(-lens, -t, side="left"))  # texts longer than t
            c = self.s[self.starts[order[:live]] + lens[:live] - 1 - t]
            todo = np.arange(live)
            while len(todo):
                a, z = self.step(c[todo], lo[todo], hi[todo])
                ok = z > a
                ok[ok] = self.changes[z[ok] - 1] > self.changes[a[ok]]
                took = todo[ok]
                lo[took], hi[took], ln[took] = a[ok], z[ok], ln[took] + 1
                todo = todo[~ok]
                todo = todo[ln[todo] > 0]
                if len(todo):
                    x, y = self.lcp[lo[todo]], self.lcp[hi[todo]]
                    k = np.where(x >= y, lo[todo], hi[todo])
                    v = np.maximum(x, y)
                    root = v <= 0
                    lo[todo] = np.where(root, 0, self.before[k])
                    hi[todo] = np.where(root, self.n, self.after[k])
                    ln[todo] = np.maximum(0, v)
            hit = np.flatnonzero(ln[:live] >= least)
            if len(hit):
                found.append((order[hit], lens[hit] - 1 - t, ln[hit].copy(), lo[hit].copy()))
        if not found:
            e = np.zeros(0, np.int64)
            return e, e, e, e
        return tuple(np.concatenate(x) for x in zip(*found))

    def owners_of(self, rows: np.ndarray, least: int) -> list[np.ndarray]:
        """The distinct sets of owners (sorted, two or more) of the ``least``-character stretches at these rows."""
        run = np.cumsum(self.lcp[: self.n] < least)
        runs = np.unique(run[rows])
        first = np.searchsorted(run, runs)
        end = np.searchsorted(run, runs, side="right")
        size = end - first
        which = np.repeat(np.arange(len(runs)), size)
        docs = self.doc[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)]
        o = np.lexsort((docs, which))
        which, docs = which[o], docs[o]
        new = np.concatenate([[True], (which[1:] != which[:-1]) | (docs[1:] != docs[:-1])])
        which, docs = which[new], docs[new]
        out = {}
        bounds = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1], [True]]))
        for a, z in zip(bounds[:-1], bounds[1:]):
            if z - a > 1:
                out[docs[a:z].tobytes()] = docs[a:z]
        return list(out.values())
