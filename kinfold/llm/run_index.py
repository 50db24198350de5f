"""A run-length compressed text index, and matching statistics streamed against it.

The Burrows-Wheeler transform of a repetitive text has few runs of equal symbols. The index keeps, for
each run, its symbol, where it starts, how often the symbol occurs before it, and the text positions
of its first and last row. A pattern is read from right to left. While the symbol in front of the
match equals that of the current row, the match grows by one; otherwise it goes on at the nearest run of
the symbol above or below, whose sampled position tells, by comparing texts, how much of the match is kept.
Many patterns are read at a time, each in its own row of an array.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; ``text`` holds numbers, and no suffix is a prefix of another."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    k = 1
    if rank.max(initial=0) < (1 << 15) - 1 and n > 4:
        # Four symbols fit one number, so sorting begins with these.
        first = rank + 1
        rank = first << 48
        for i in (1, 2, 3):
            rank[: n - i] |= first[i:] << (48 - 16 * i)
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        k = 4
    while True:
        second = np.zeros(n, np.int64)
        if k < n:
            second[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        k *= 2


class RunIndex:
    """Index of several sequences of numbers; nothing matches across two of them."""

    def __init__(self, sequences: list[np.ndarray]):
        m = len(sequences)
        # Each sequence ends with a mark of its own, smaller than all else.
        self.text = np.concatenate([x for i, s in enumerate(sequences) for x in (s.astype(np.int64) + m, [i])])
        self.shift = m
        order = suffix_array(self.text)
        n = len(order)
        last = self.text[order - 1]
        starts = np.flatnonzero(np.concatenate([[True], last[1:] != last[:-1]]))
        self.n = n
        self.starts = starts
        self.sizes = np.diff(np.append(starts, n))
        self.symbols, self.run_symbol = np.unique(last[starts], return_inverse=True)
        self.first, self.last = order[starts], order[starts + self.sizes - 1]
        # Runs by symbol, and in each symbol by place.
        self.by_symbol = np.argsort(self.run_symbol, kind="stable")
        sizes = self.sizes[self.by_symbol]
        before = np.cumsum(sizes) - sizes  # rows with a smaller symbol, or the symbol further up
        self.goes_to = np.empty(len(starts), np.int64)
        self.goes_to[self.by_symbol] = before
        self.keys = self.run_symbol[self.by_symbol] * (n + 1) + starts[self.by_symbol]

    @property
    def runs(self) -> int:
        return len(self.starts)

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int = 16) -> np.ndarray:
        """Length of the common beginning of the suffixes at ``a`` and ``b``, at most ``most``."""
        out = np.zeros(len(a), np.int64)
        open_ = np.flatnonzero(most > 0)
        along = np.arange(step)
        while len(open_):
            x = a[open_] + out[open_]
            y = b[open_] + out[open_]
            i, j = x[:, None] + along, y[:, None] + along
            same = (self.text[np.minimum(i, self.n - 1)] == self.text[np.minimum(j, self.n - 1)]) & (i < self.n) & (j < self.n)
            k = np.where(same.all(axis=1), step, same.argmin(axis=1))
            out[open_] += k
            open_ = open_[(k == step) & (out[open_] < most[open_])]
        return np.minimum(out, most)

    def matching_statistics(self, patterns: list[np.ndarray]) -> np.ndarray:
        """For each pattern a row with, at each place, the length of the longest match that starts there."""
        width = max(map(len, patterns), default=0)
        grid = np.full((len(patterns), width), -1, np.int64)
        for i, p in enumerate(patterns):
            grid[i, : len(p)] = p.astype(np.int64) + self.shift
        code = np.searchsorted(self.symbols, grid)
        code = np.where(self.symbols[np.minimum(code, len(self.symbols) - 1)] == grid, code, -1)
        out = np.zeros((len(patterns), width), np.int64)
        row = np.zeros(len(patterns), np.int64)
        place = np.full(len(patterns), self.first[0], np.int64)
        length = np.zeros(len(patterns), np.int64)
        for t in range(width - 1, -1, -1):
            c = code[:, t]
            run = np.searchsorted(self.starts, row, side="right") - 1
            ahead = np.where(c >= 0, self.run_symbol[run] == c, False)
            jump = np.flatnonzero(~ahead & (c >= 0))
            if len(jump):
                below = np.searchsorted(self.keys, c[jump] * (self.n + 1) + row[jump])
                best = np.full(len(jump), -1, np.int64)
                kept = np.full(len(jump), -1, np.int64)
                sample = np.zeros(len(jump), np.int64)
                for up in (True, False):
                    k = below - 1 if up else below
                    inside = (k >= 0) & (k < len(self.keys))
                    r = self.by_symbol[np.clip(k, 0, len(self.keys) - 1)]
                    inside &= self.run_symbol[r] == c[jump]
                    at = (self.last if up else self.first)[r]
                    same = self._common(at, place[jump], np.where(inside, length[jump], 0))
                    better = inside & (same > kept)
                    best, kept, sample = np.where(better, r, best), np.where(better, same, kept), np.where(better, at, sample)
                    if up:
                        from_above = better
                    else:
                        from_above &= ~better
                run[jump] = best
                row[jump] = np.where(from_above, self.starts[best] + self.sizes[best] - 1, self.starts[best])
                place[jump] = sample
                length[jump] = kept
            go = c >= 0
            row = np.where(go, self.goes_to[run] + row - self.starts[run], row)
            place = np.where(go, place - 1, place)
            place = np.where(place < 0, self.n - 1, place)
            length = np.where(go, length + 1, 0)
            out[:, t] = length
        return out
