"""Small gradient-boosted trees for binary labels, and a monotone calibration of their scores."""

from __future__ import annotations

import numpy as np


def _bins(x: np.ndarray, n: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(col, np.linspace(0, 1, n + 1)[1:-1])) for col in x.T]


class Boosted:
    """Logistic loss, Newton leaves, complete trees of fixed depth over quantile bins."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        x, y = np.asarray(x, float), np.asarray(y, float)
        cuts = _bins(x, self.bins)
        codes = np.stack([np.searchsorted(c, col, "right") for c, col in zip(cuts, x.T, strict=True)], 1)
        self.base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        score = np.full(len(y), self.base)
        self.feature, self.limit, self.leaf = [], [], []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p)
            feature, limit = np.zeros(2**self.depth - 1, int), np.full(2**self.depth - 1, np.inf)
            node = np.zeros(len(y), int)
            for level in range(self.depth):
                for k in range(2**level - 1, 2 ** (level + 1) - 1):
                    at = np.flatnonzero(node == k)
                    best = 1e-6
                    for f, c in enumerate(cuts):
                        if not len(c) or not len(at):
                            continue
                        gl, hl = (np.cumsum(np.bincount(codes[at, f], v[at], len(c) + 1))[:-1] for v in (g, h))
                        gt, ht = g[at].sum(), h[at].sum()
                        gain = gl**2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                        if gain.max() > best:
                            best, feature[k], limit[k] = gain.max(), f, c[gain.argmax()]
                    node[at] = 2 * k + 1 + (x[at, feature[k]] >= limit[k])
            leaf = node - (2**self.depth - 1)
            value = -self.rate * np.bincount(leaf, g, 2**self.depth) / (np.bincount(leaf, h, 2**self.depth) + self.ridge)
            score = score + value[leaf]
            self.feature.append(feature)
            self.limit.append(limit)
            self.leaf.append(value)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float)
        out = np.full(len(x), self.base)
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf, strict=True):
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] >= limit[node])
            out += leaf[node - (2**self.depth - 1)]
        return out


class Isotonic:
    """Calibrated probabilities: the pooled-adjacent-violators fit of labels on scores."""

    def fit(self, score: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(score, kind="stable")
        blocks: list[list[float]] = []
        for s, v in zip(score[order], y[order], strict=True):
            blocks.append([v, 1, s])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                v2, n2, _ = blocks.pop()
                blocks[-1][0] += v2
                blocks[-1][1] += n2
        self.start = np.array([b[2] for b in blocks])
        self.value = np.array([b[0] / b[1] for b in blocks])
        return self

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return self.value[np.clip(np.searchsorted(self.start, score, "right") - 1, 0, None)]

    def threshold(self, precision: float) -> float:
        """The least score from which on the calibrated probability reaches the precision."""
        good = np.flatnonzero(self.value >= precision)
        return float(self.start[good[0]]) if len(good) else float("inf")
