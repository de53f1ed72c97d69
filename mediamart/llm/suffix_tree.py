"""Suffix trees of symbol sequences (Ukkonen), and constant-time longest common
extensions from their Euler tours.
"""

from __future__ import annotations

import numpy as np

_OPEN = 1 << 60  # the end of a leaf's edge: it grows with the text


class SuffixTree:
    """Suffix tree of ``text`` (a list of positive ints), built left to right in
    linear time. The end mark 0, smaller than every symbol, is added to it.

    Edges lie in one dictionary from (node, first symbol) to the child.
    """

    def __init__(self, text: list[int]):
        self.text = s = text + [0]
        self.sigma = sigma = max(s) + 1
        self.edges = edges = {}
        self.start, self.end, self.suffix = [0], [0], [-1]
        start, end, suffix, link = self.start, self.end, self.suffix, [0]
        node = edge = length = remaining = 0
        for i, c in enumerate(s):
            remaining += 1
            unlinked = 0
            while remaining:
                if not length:
                    edge = i
                key = node * sigma + s[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i)
                    end.append(_OPEN)
                    suffix.append(i - remaining + 1)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    at = start[child]
                    span = end[child] - at
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if s[at + length] == c:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    split = edges[key] = len(start)
                    start += (at, i)
                    end += (at + length, _OPEN)
                    suffix += (-1, i - remaining + 1)
                    link += (0, 0)
                    start[child] = at + length
                    edges[split * sigma + c] = split + 1
                    edges[split * sigma + s[at + length]] = child
                    if unlinked:
                        link[unlinked] = split
                    unlinked = split
                remaining -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - remaining + 1

    def tour(self, descending: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The Euler tour at its leaves: their suffixes in the order of the
        tour, and the depth of the shallowest node passed since the leaf before.

        Children go by ascending or descending first symbol; the end mark is
        always first, so a prefix stands before the longer text.
        """
        keys = np.fromiter(self.edges, np.int64, len(self.edges))
        children = np.fromiter(self.edges.values(), np.int64, len(keys))
        parents, symbols = np.divmod(keys, self.sigma)
        if descending:
            symbols = np.where(symbols > 0, self.sigma - symbols, 0)
        order = np.lexsort((-symbols, parents))  # reversed: the stack turns it round
        first = np.searchsorted(parents[order], np.arange(len(self.start) + 1)).tolist()
        children = children[order].tolist()
        start, end, suffix = self.start, self.end, self.suffix
        leaves, valleys = [], []
        stack = [(0, 0, 0)]
        while stack:
            node, above, valley = stack.pop()
            if suffix[node] >= 0:
                leaves.append(suffix[node])
                valleys.append(valley)
                continue
            depth = above + end[node] - start[node]
            below = children[first[node]:first[node + 1]]
            stack += [(x, depth, depth) for x in below]
            if below:
                stack[-1] = (below[-1], depth, valley)
        return np.array(leaves), np.array(valleys)


class Extension:
    """Longest common extensions of pairs of suffixes in constant time: the depth
    of the lowest common ancestor is the least depth on the tour between two
    leaves, looked up in a sparse table."""

    def __init__(self, tree: SuffixTree):
        leaves, valleys = tree.tour()
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        self._least = [valleys.astype(np.int32)]
        while 2 << (len(self._least) - 1) <= len(valleys):
            low, half = self._least[-1], 1 << (len(self._least) - 1)
            self._least.append(np.minimum(low[:-half], low[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common prefix lengths of the suffixes ``i`` and ``j`` (i <> j)."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self._least[k][a[at]], self._least[k][b[at] - (1 << k)])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For every position the next one with a smaller value, else the length."""
    values, found, open_ = rank.tolist(), [len(rank)] * len(rank), []
    for i, x in enumerate(values):
        while open_ and values[open_[-1]] > x:
            found[open_.pop()] = i
        open_.append(i)
    return np.array(found, np.int64)


def periodic_runs(text: list[int], least: int) -> np.ndarray:
    """All (start, length, period) of the maximal runs of ``text`` with length at
    least ``least`` and twice the smallest period, by start, then period.

    A run holds the longest Lyndon word at one of its positions under one of the
    two symbol orders, as long as its period; so those words are the candidates
    (two a position). Each is extended to the right and, over the reversed text,
    to the left as far as its period goes on.
    """
    n = len(text)
    if n < 2:
        return np.empty((0, 3), np.int64)
    tree = SuffixTree(text)
    right = Extension(tree)
    other = np.empty(n + 1, np.int64)
    other[tree.tour(descending=True)[0]] = np.arange(n + 1)
    ends = [next_smaller(rank[:n]) for rank in (right.rank, other)]
    del tree
    left = Extension(SuffixTree(text[::-1]))
    start = np.tile(np.arange(n), 2)
    period = np.concatenate(ends) - start
    start, period = np.unique(np.stack([start, period], 1), axis=0).T
    again = start + period
    after = np.zeros(len(start), np.int64)
    at = np.flatnonzero(again < n)
    after[at] = right(start[at], again[at])
    before = np.zeros(len(start), np.int64)
    at = np.flatnonzero(start > 0)
    before[at] = left(n - start[at], n - again[at])
    found = np.stack([start - before, before + period + after, period], 1)
    found = found[(found[:, 1] >= least) & (found[:, 1] >= 2 * period)]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]
