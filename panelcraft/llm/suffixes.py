"""Suffix order of many short sequences at once, and the longest match of each place with any other."""

from __future__ import annotations

import numpy as np


class SuffixOrder:
    """All suffixes of ``pieces``, each piece ended by a symbol of its own, sorted by prefix doubling.

    ``ranks[i]`` orders the suffixes by their first 2**i symbols, so it also tells in a few steps how far two
    suffixes agree.
    """

    def __init__(self, pieces: list[np.ndarray]):
        lengths = np.array([len(p) for p in pieces], np.int64)
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        n = int(self.ends[-1]) + 1 if len(pieces) else 0
        values = np.unique(np.concatenate(pieces), return_inverse=True)[1] if n > len(pieces) else np.zeros(0, np.int64)
        self.symbols = np.empty(n, np.int32)
        body = np.ones(n, bool)
        body[self.ends] = False
        self.symbols[body] = values + len(pieces)
        del values, body
        self.symbols[self.ends] = np.arange(len(pieces))
        rank, span, longest = self.symbols, 1, int(lengths.max(initial=0)) + 1
        self.ranks = [rank]
        while span < longest:
            base = int(rank.max()) + 2
            key = rank * np.int64(base)
            key[: n - span] += rank[span:]
            key[: n - span] += 1
            if span == 1 and base**4 < 1 << 62:  # pairs tell each other apart as they are; only fours need sorting
                rank, span = key, 2
                self.ranks.append(key.astype(np.int32) if base**2 < 1 << 31 else key)
                continue
            order = np.argsort(key, kind="stable").astype(np.int32)
            key = key[order]
            new = np.zeros(n, bool)
            np.not_equal(key[1:], key[:-1], out=new[1:])
            del key
            rank = np.empty(n, np.int32)
            rank[order] = np.cumsum(new, dtype=np.int32)
            self.ranks.append(rank)
            span *= 2
            if new[1:].all():  # every suffix has a place of its own; the ranks of longer prefixes would be the same
                break
        self.order = order if span > 2 else np.argsort(rank, kind="stable")

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at ``a`` and ``b`` share."""
        a, b, n = a.copy(), b.copy(), len(self.symbols)
        total = np.zeros(len(a), np.int64)
        for i in range(len(self.ranks) - 1, -1, -1):
            inside = (a < n) & (b < n)
            same = inside.copy()
            same[inside] = self.ranks[i][a[inside]] == self.ranks[i][b[inside]]
            step = same.astype(np.int64) << i
            total, a, b = total + step, a + step, b + step
        return total
