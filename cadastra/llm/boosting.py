"""Histogram gradient-boosted trees for a yes/no label in numpy, stored as flat arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: split feature and threshold of each inner node, value of each leaf (after shrinkage)."""

    feature: np.ndarray  # trees x (2**depth - 1)
    threshold: np.ndarray
    value: np.ndarray  # trees x 2**depth
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for the rows of x."""
        depth = self.value.shape[1].bit_length() - 1
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - (len(v) - 1)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Fit by Newton boosting on quantile histograms. Constant labels give a constant score; no rows, 0.5."""
    n, features = x.shape
    mean = (y.sum() + 0.5) / (n + 1.0)
    base = float(np.log(mean / (1 - mean)))
    feature, threshold = np.zeros((trees, 2**depth - 1), np.int32), np.full((trees, 2**depth - 1), np.inf)
    value = np.zeros((trees, 2**depth))
    if not n:
        return Trees(feature, threshold, value, base)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(features)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    flat = binned + np.arange(features) * bins
    total = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width = 2**level
            at = ((node - (width - 1))[:, None] * (features * bins) + flat).ravel()
            size = width * features * bins
            hist = [np.bincount(at, np.repeat(w, features), size).reshape(width, features, bins).cumsum(2) for w in (g, h)]
            gl, hl = hist
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < least) | (ht - hl < least)] = -1
            best = gain.reshape(width, -1).argmax(1)
            for k in range(width):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    feature[t, width - 1 + k], threshold[t, width - 1 + k] = f, edges[f][b]
            right = x[np.arange(n), feature[t][node]] > threshold[t][node]
            node = 2 * node + 1 + right
        leaf = node - (2**depth - 1)
        value[t] = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        total += value[t][leaf]
    return Trees(feature, threshold, value, base)
