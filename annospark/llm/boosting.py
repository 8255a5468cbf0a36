"""Gradient-boosted trees in numpy: logistic loss, histogram splits, trees of a
fixed depth grown level by level."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """A binary classifier over float features. Trees are complete; a node
    without a gainful split sends every row to the left."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, ridge: float = 1.0, least: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge, self.least = trees, depth, rate, bins, ridge, least
        self.base, self.grown = 0.0, []

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, width = x.shape
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if n else 0.5
        self.base = float(np.log(share / (1 - share)))
        q = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, f], q)) if n else np.zeros(0) for f in range(width)]
        if not n or y.min() == y.max():
            return self
        binned, score = self._binned(x), np.full(n, self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            node, splits = np.zeros(n, np.int64), []
            for level in range(self.depth):
                nodes = 1 << level
                feature, cut, gain = np.zeros(nodes, np.int64), np.full(nodes, self.bins), np.full(nodes, 1e-9)
                for f in range(width):
                    cell = node * self.bins + binned[:, f]
                    g = np.bincount(cell, grad, nodes * self.bins).reshape(nodes, -1).cumsum(1)
                    h = np.bincount(cell, hess, nodes * self.bins).reshape(nodes, -1).cumsum(1)
                    gt, ht = g[:, -1:], h[:, -1:]
                    won = g**2 / (h + self.ridge) + (gt - g) ** 2 / (ht - h + self.ridge) - gt**2 / (ht + self.ridge)
                    won[(h < self.least) | (ht - h < self.least)] = 0
                    best = won.argmax(1)
                    better = won[np.arange(nodes), best] > gain
                    feature[better], cut[better] = f, best[better]
                    gain[better] = won[np.arange(nodes), best][better]
                splits.append((feature, cut))
                node = 2 * node + (binned[np.arange(n), feature[node]] > cut[node])
            leaves = 1 << self.depth
            value = np.bincount(node, grad, leaves) / (np.bincount(node, hess, leaves) + self.ridge) * self.rate
            score += value[node]
            self.grown.append((splits, value))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 for each row."""
        score = np.full(len(x), self.base)
        if self.grown and len(x):
            binned, rows = self._binned(x), np.arange(len(x))
            for splits, value in self.grown:
                node = np.zeros(len(x), np.int64)
                for feature, cut in splits:
                    node = 2 * node + (binned[rows, feature[node]] > cut[node])
                score += value[node]
        return 1 / (1 + np.exp(-score))
