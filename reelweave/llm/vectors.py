"""Shared handling of embedding columns and of links inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not empty, without null or non-finite components, and not all zero."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return x.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(x, lambda v: v != 0)


def matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in vectors], dtype=np.float64)


def units(rows: np.ndarray) -> np.ndarray:
    """The rows scaled to length 1; the largest component is scaled out first, so that squares neither overflow nor vanish."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row in double precision, summed in one order, so that equal vectors have equal cosines."""
    left, right = (x / np.abs(x).max(axis=1, keepdims=True) for x in (left, right))
    lengths = np.sqrt((left * left).sum(axis=1)) * np.sqrt((right * right).sum(axis=1))
    return (left * right).sum(axis=1) / lengths


class Forest:
    """Spanning forest of links that arrive in groups: only links that join two components are kept."""

    def __init__(self, size: int):
        self.group = np.arange(size)
        self.first: list[np.ndarray] = []
        self.second: list[np.ndarray] = []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.group[i], self.group[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            if not len(i):
                return
            # each component takes one link to a smaller one; chains are followed to their ends
            heads, chosen = np.unique(np.maximum(a, b), return_index=True)
            self.first.append(i[chosen])
            self.second.append(j[chosen])
            target = np.arange(len(self.group))
            target[heads] = np.minimum(a, b)[chosen]
            while not np.array_equal(onward := target[target], target):
                target = onward
            self.group = target[self.group]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        none = [np.zeros(0, np.int64)]
        return np.concatenate(self.first or none), np.concatenate(self.second or none)
