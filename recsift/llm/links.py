"""Union-find over a bounded block of rows inside a task."""

from __future__ import annotations

import numpy as np


class Forest:
    """Disjoint sets of ``0 .. n-1``; ``join`` says whether two sets became one."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return int(i)

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True

    def roots(self) -> np.ndarray:
        """The root of every element."""
        p = self.parent
        while True:
            q = p[p]
            if np.array_equal(q, p):
                return p
            self.parent = p = q
