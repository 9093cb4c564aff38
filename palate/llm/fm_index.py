"""A compressed full-text index over word ids: BWT in a wavelet matrix, searched backwards.

With the lengths that neighbouring suffixes share, a match that cannot be extended is shortened to
the next place where the index branches, which gives the matching statistics of streamed texts.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class BitRank:
    """A bit vector of n bits with the number of ones before every position, in 1.5 n bits."""

    def __init__(self, bits: np.ndarray) -> None:
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, bool)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words) + 1, np.uint32)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        word = at >> 6
        mask = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class RangeLeast:
    """Least value of any range, and the ends of runs of values at or above a bound."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 * (width := 1 << (len(self.levels) - 1)) <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[: len(last) - width], last[width:]))

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least value in each non-empty range [low, high)."""
        out = np.empty(len(low), self.levels[0].dtype)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            here = np.flatnonzero(level == k)
            values = self.levels[k]
            out[here] = np.minimum(values[low[here]], values[high[here] - (1 << int(k))])
        return out

    def left(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Last position at or before ``at`` whose value is below ``bound``; there must be one."""
        at = at.copy()
        for k, values in reversed(list(enumerate(self.levels))):
            first = at - (1 << k) + 1
            go = (first > 0) & (values[np.maximum(first, 0)] >= bound)
            at[go] -= 1 << k
        return at

    def right(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """First position at or after ``at`` whose value is below ``bound``; there must be one."""
        at = at.copy()
        for k, values in reversed(list(enumerate(self.levels))):
            go = (at < len(values)) & (values[np.minimum(at, len(values) - 1)] >= bound)
            at[go] += 1 << k
        return at


class FmIndex:
    """Index over segments of word ids (1 and up); matches never cross a segment's end."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray) -> None:
        segments = len(sizes)
        n = len(words) + segments
        ends = np.cumsum(sizes + 1) - 1
        symbols = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        symbols[inside] = words
        self.symbols = symbols
        self.segment = np.repeat(np.arange(segments), sizes + 1)
        self.suffixes, self.shared = self._sorted(symbols, ends)
        bwt = symbols[self.suffixes - 1]  # the text is taken as a ring: the first suffix follows the last end
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=int(symbols.max(initial=0)) + 2))))
        self.levels = []
        left = bwt
        for bit in range(max(1, int(symbols.max(initial=1)).bit_length()))[::-1]:
            ones = (left >> bit) & 1 == 1
            self.levels.append((bit, BitRank(ones), int(len(left) - ones.sum())))
            left = np.concatenate((left[~ones], left[ones]))
        known = np.arange(len(self.smaller) - 1)
        self.base = self._down(known, np.zeros(len(known), np.int64))

    @staticmethod
    def _sorted(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array by prefix doubling, and the length that each suffix shares with the one
        before it (-1 at both ends). Every segment end is a symbol of its own, so the number of
        rounds is the logarithm of the longest segment, and nothing is shared beyond an end."""
        n = len(symbols)
        rank = symbols + len(ends)
        rank[ends] = np.arange(len(ends))
        step = 1
        rounds = []
        while True:
            rounds.append((step, rank.astype(np.int32)))
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1 if step < n else 0
            key = rank * (n + int(rank.max(initial=0)) + 2) + after
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.zeros(n, np.int64)
            new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            rank = new
            if rank.max(initial=0) == n - 1 or step >= n:
                break
            step *= 2
        shared = np.full(n + 1, -1, np.int32)
        if n > 1:
            left, right = order[:-1].copy(), order[1:].copy()
            for step, rank in reversed(rounds):
                equal = rank[left] == rank[right]
                left[equal] += step
                right[equal] += step
            shared[1:n] = left - order[:-1]
        return order, shared

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, ranks, zeros in self.levels:
            ones = ranks.rank(at)
            at = np.where((symbol >> bit) & 1 == 1, zeros + ones, at - ones)
        return at

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of the suffix array that starts with each row of ``patterns``; empty if none.
        A word id of 0 or above the largest one occurs nowhere."""
        q, length = patterns.shape
        low, high = np.zeros(q, np.int64), np.full(q, len(self.symbols), np.int64)
        for j in range(length)[::-1]:
            live = np.flatnonzero((low < high) & (patterns[:, j] > 0) & (patterns[:, j] < len(self.base)))
            dead = np.ones(q, bool)
            dead[live] = False
            high[dead] = low[dead]
            c = patterns[live, j]
            low[live], high[live] = self._step(c, low[live], high[live])
        return low, high

    def _step(self, c: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the words ``c`` followed by what the given intervals start with."""
        both = self._down(np.concatenate((c, c)), np.concatenate((low, high)))
        first = self.smaller[c] - self.base[c]
        return first + both[: len(c)], first + both[len(c) :]

    def matching(self, words: np.ndarray, sizes: np.ndarray, before: np.ndarray, owner: np.ndarray, least: int = 1) -> np.ndarray:
        """Matching statistics of streamed texts: for every position the length of the longest match
        that starts there and occurs in a segment whose ``owner`` is below the text's ``before``.

        Texts are streamed from their ends, all in step, one word at a time: a match is extended by
        the word before it, and while no such segment has the extension, shortened to the next
        branch. Words must be those of the index. A text in which no match can reach ``least`` any
        more is dropped; its remaining positions get 0."""
        segment_owner = owner[self.segment[self.suffixes]]
        lowest, branch = RangeLeast(segment_owner), RangeLeast(self.shared)
        out = np.zeros(len(words), np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes, start, before = sizes[order], (np.cumsum(sizes) - sizes)[order], before[order]
        low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), len(self.symbols), np.int64)
        length = np.zeros(len(sizes), np.int64)
        alive = np.flatnonzero(sizes >= least)
        step = 0
        while len(alive := alive[sizes[alive] > step]):
            at = sizes[alive] - 1 - step
            todo, place = alive, start[alive] + at
            while len(todo):
                a, b = self._step(words[place], low[todo], high[todo])
                good = a < b
                good[good] = lowest.of(a[good], b[good]) < before[todo[good]]
                done = todo[good]
                low[done], high[done] = a[good], b[good]
                length[done] += 1
                out[place[good]] = length[done]
                todo, place = todo[~good], place[~good]
                # at the root a word that occurs nowhere is passed over
                inner = (length[todo] > 0) & (length[todo] - 1 + sizes[todo] - step >= least)
                length[todo[~inner]] = 0
                low[todo[~inner]], high[todo[~inner]] = 0, len(self.symbols)
                todo, place = todo[inner], place[inner]
                depth = np.maximum(self.shared[low[todo]], self.shared[high[todo]]).astype(np.int64)
                root = depth <= 0
                depth[root] = 0
                length[todo] = depth
                low[todo], high[todo] = branch.left(low[todo], depth), branch.right(high[todo], depth)
            step += 1
            alive = alive[length[alive] + sizes[alive] - step >= least]
        return out

    def least(self, low: np.ndarray, high: np.ndarray, of_segment: np.ndarray) -> np.ndarray:
        """Least value of ``of_segment`` over the suffixes in each non-empty interval. The
        intervals are those of equally long patterns, so any two are equal or disjoint."""
        values = np.concatenate((of_segment[self.segment[self.suffixes]], [np.iinfo(np.int64).max]))
        starts, back = np.unique(low, return_inverse=True)
        stops = np.zeros(len(starts), np.int64)
        stops[back] = high
        if not len(starts):
            return np.zeros(0, np.int64)
        return np.minimum.reduceat(values, np.stack((starts, stops), 1).ravel())[::2][back]
