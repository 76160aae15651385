"""A run-length index of a collection of byte strings.

The Burrows-Wheeler transform of the strings, laid end to end, is kept as runs, and
the suffix array only at both ends of each run. From these samples the matching
statistics of the whole collection against itself are streamed in text order: the
match of a position with its neighbour in suffix order is one shorter than that of
the position before it, unless a run ends there, so only run ends are compared.
"""

from __future__ import annotations

import numpy as np

#: Ends every string; never part of UTF-8.
SEPARATOR = 0xFF


def _packed(text: np.ndarray, reach: int) -> np.ndarray:
    """The eight bytes from each position on, as one number; zeros behind the end."""
    padded = np.zeros(len(text) + reach + 8, np.uint64)
    padded[: len(text)] = text
    word = padded[: len(text) + reach].copy()
    for k in range(1, 8):
        word = word << np.uint64(8) | padded[k : len(text) + reach + k]
    return word


def suffix_order(text: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their first ``depth`` bytes at least, then by position."""
    n = len(text)
    key = word[:n]
    order = np.argsort(key)
    ordered = key[order]
    start = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    size = np.diff(np.r_[start, n])
    rank = np.zeros(n + depth + 8, np.int64)
    rank[order] = np.repeat(start, size) + 1
    open_at = np.flatnonzero(np.repeat(size > 1, size))
    reach = 8
    while len(open_at) and reach < depth:
        own = order[open_at]
        key = rank[own] << np.int64(32) | rank[own + reach]
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[open_at] = own
        first = np.r_[True, key[1:] != key[:-1]]
        at = np.flatnonzero(first)
        size = np.diff(np.r_[at, len(own)])
        rank[own] = np.repeat(open_at[at], size) + 1
        open_at = open_at[np.repeat(size > 1, size)]
        reach *= 2
    # What is still equal stands by position.
    return order[np.lexsort((order, rank[order]))] if len(open_at) else order


class RunIndex:
    """Index of strings; ``run_chars``, ``run_lengths`` and samples ``head`` and ``tail``."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(np.r_[0, self.sizes[:-1] + 1]).astype(np.int64)
        joined = bytes([SEPARATOR]).join(strings) + bytes([SEPARATOR])
        text = np.frombuffer(joined, np.uint8)
        self.n = len(text)
        depth = int(self.sizes.max()) + 1
        ends = np.repeat(self.starts + self.sizes, self.sizes + 1)
        self.left = ends - np.arange(self.n)  # bytes up to the end of the own string
        self._word = _packed(text, depth + 8)
        order = suffix_order(text, self._word, depth)
        bwt = text[order - 1]
        change = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1
        heads = np.r_[0, change]
        self.run_chars = bwt[heads]
        self.run_lengths = np.diff(np.r_[heads, self.n])
        # A string's first byte has no byte before it to stream from: runs of separators
        # are sampled at every place.
        inside = np.repeat(self.run_chars == SEPARATOR, self.run_lengths)
        at_head = inside.copy()
        at_head[heads] = True
        at_tail = inside
        at_tail[heads + self.run_lengths - 1] = True
        first, last = np.flatnonzero(at_head), np.flatnonzero(at_tail)
        self.head, self.before = order[first], order[np.maximum(first - 1, 0)]
        self.tail, self.after = order[last], order[np.minimum(last + 1, self.n - 1)]

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of positions, within their strings."""
        limit = np.minimum(self.left[a], self.left[b])
        length = np.zeros(len(a), np.int64)
        active = np.flatnonzero((a != b) & (limit > 0))
        while len(active):
            x = self._word[a[active] + length[active]] ^ self._word[b[active] + length[active]]
            same = x == 0
            part = active[~same]
            # Leading equal bytes of the first word that differs.
            for k in range(8, 64, 8):
                length[part] += x[~same] < np.uint64(1 << k)
            length[active[same]] += 8
            active = active[same]
            active = active[length[active] < limit[active]]
        return np.minimum(length, limit)

    def _stream(self, places: np.ndarray, values: np.ndarray) -> np.ndarray:
        sample = np.full(self.n, -1, np.int64)
        sample[places] = values
        last = np.maximum.accumulate(np.where(sample >= 0, np.arange(self.n), 0))
        return np.maximum(np.maximum(sample[last], 0) - (np.arange(self.n) - last), 0)

    def matching_statistics(self) -> np.ndarray:
        """For each position, the longest match of what starts there with another position."""
        up = self._stream(self.head, self._common(self.head, self.before))
        down = self._stream(self.tail, self._common(self.tail, self.after))
        return np.maximum(up, down)

    def repeated(self, length: int) -> np.ndarray:
        """Whether the ``length`` bytes from each position on also start elsewhere."""
        return (self.matching_statistics() >= length) & (self.left >= length)
