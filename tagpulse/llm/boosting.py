"""Gradient-boosted trees and isotonic calibration for a bounded sample of rows."""

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """A full binary tree by level: `feature` and `threshold` of its inner nodes, `value` of its leaves."""
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while node.size and node[0] < len(self.feature):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.feature[node]] > self.threshold[node])
        return self.value[node - len(self.feature)]


@dataclass
class Boosted:
    """Log-odds as a sum of trees."""
    start: float
    trees: list[Tree] = field(default_factory=list)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((t(x) for t in self.trees), np.zeros(len(x)))


def fit_tree(bins, edges, gradient, weight, depth: int, ridge: float, least: float, rate: float) -> Tree:
    """The tree that lowers the second-order loss most, split by split, over binned features."""
    rows, features = bins.shape
    width = max(len(e) for e in edges) + 1
    inner = (1 << depth) - 1
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(rows, np.int64)
    for level in range(depth):
        first, count = (1 << level) - 1, 1 << level
        at = node - first
        best = np.zeros(count)
        split = np.full(count, width)
        for f in range(features):
            cell = at * width + bins[:, f]
            g = np.bincount(cell, gradient, count * width).reshape(count, width).cumsum(1)
            h = np.bincount(cell, weight, count * width).reshape(count, width).cumsum(1)
            all_g, all_h = g[:, -1:], h[:, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < least) | (all_h - h < least)] = 0
            gain[:, len(edges[f]):] = 0
            k = gain.argmax(1)
            better = gain[np.arange(count), k] > best + 1e-12
            best = np.where(better, gain[np.arange(count), k], best)
            split = np.where(better, k, split)
            feature[first:first + count][better] = f
            for i in np.flatnonzero(better):
                threshold[first + i] = edges[f][k[i]]
        node = 2 * node + 1 + (bins[np.arange(rows), feature[node]] > split[at])
    leaf = node - inner
    g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, weight, inner + 1)
    return Tree(feature, threshold, -rate * g / (h + ridge))


def fit_boosted(x: np.ndarray, y: np.ndarray, trees=60, depth=3, rate=0.2, ridge=1.0, least=1.0, max_bins=64) -> Boosted:
    """Boosts the logistic loss. With one class only, the model is its smoothed log-odds."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Boosted(float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, max_bins + 1)[1:-1], method="lower")) for c in x.T]
    bins = np.column_stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)])
    score = np.full(len(y), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        tree = fit_tree(bins, edges, p - y, p * (1 - p), depth, ridge, least, rate)
        model.trees.append(tree)
        score += tree(x)
    return model


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (score, chance) of the rising step fit by pooling neighbours that violate the order, to be read by np.interp.

    Pools are smoothed by one row of the overall share, so that a pool of few rows is not certain.
    """
    if not len(y):
        return np.zeros(1), np.zeros(1)
    order = np.argsort(score, kind="stable")
    level, inverse = np.unique(score[order], return_inverse=True)
    n, hits = np.bincount(inverse).astype(float), np.bincount(inverse, y[order])
    pools: list[list[float]] = []  # rows, hits, first and last score
    for s, a, b in zip(level, n, hits):
        pools.append([a, b, s, s])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            a, b, _, last = pools.pop()
            pools[-1][0] += a
            pools[-1][1] += b
            pools[-1][3] = last
    share = y.mean()
    chance = np.maximum.accumulate([(b + share) / (a + 1) for a, b, *_ in pools])
    knots = np.array([[p[2], p[3]] for p in pools]).ravel()
    return knots, np.repeat(chance, 2)
