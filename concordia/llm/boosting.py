"""Gradient boosted trees for small training tables (numpy, on the driver).

Logistic loss, second-order leaf values, and splits at quantiles of each feature.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_CUTS = 32


@dataclass
class Tree:
    """A complete binary tree: inner nodes split ``feature <= cut``, leaves have values."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def leaf(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(len(self.value).bit_length() - 1):
            right = x[np.arange(len(x)), self.feature[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return node - len(self.feature)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.leaf(x)]


@dataclass
class Boosted:
    bias: float
    trees: list[Tree] = field(default_factory=list)

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.bias)
        for tree in self.trees:
            margin += tree.predict(x)
        return 1 / (1 + np.exp(-margin))


def _tree(x, bins, cuts, gradient, hessian, depth, penalty) -> Tree:
    inner = (1 << depth) - 1
    feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
    node = np.zeros(len(x), dtype=np.int64)
    for at in range(inner):
        members = np.flatnonzero(node == at)
        g, h = gradient[members], hessian[members]
        base, best = g.sum() ** 2 / (h.sum() + penalty), 1e-9
        for f in range(x.shape[1]):
            if len(cuts[f]) and len(members):
                gl = np.cumsum(np.bincount(bins[members, f], g, len(cuts[f]) + 1))[:-1]
                hl = np.cumsum(np.bincount(bins[members, f], h, len(cuts[f]) + 1))[:-1]
                gain = gl**2 / (hl + penalty) + (g.sum() - gl) ** 2 / (h.sum() - hl + penalty) - base
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, feature[at], cut[at] = gain[k], f, cuts[f][k]
        node[members] = 2 * at + 1 + (x[members, feature[at]] > cut[at])
    leaf = node - inner
    g = np.bincount(leaf, gradient, inner + 1)
    h = np.bincount(leaf, hessian, inner + 1)
    return Tree(feature, cut, -g / (h + penalty))


def boost(
    x: np.ndarray, y: np.ndarray, rounds: int = 30, depth: int = 3, rate: float = 0.3, penalty: float = 1.0
) -> Boosted:
    """Trees for labels 0 and 1, of which both must occur."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, _CUTS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    cuts = [c[c < x[:, f].max()] for f, c in enumerate(cuts)]
    bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    model = Boosted(float(np.log(y.mean() / (1 - y.mean()))))
    margin = np.full(len(x), model.bias)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = _tree(x, bins, cuts, p - y, p * (1 - p), depth, penalty)
        tree.value *= rate
        model.trees.append(tree)
        margin += tree.predict(x)
    return model
