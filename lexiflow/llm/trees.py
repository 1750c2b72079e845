"""Gradient-boosted trees for two classes over binned features, in numpy."""

from __future__ import annotations

import numpy as np


class Boosted:
    """``fit`` on uint8 features; ``predict`` gives log odds.

    Trees are grown level by level.  Each level sums gradients by node, feature
    and bin, and splits every node where the logistic loss falls most.
    """

    def __init__(self, trees: int = 40, depth: int = 4, rate: float = 0.3, l2: float = 1.0, least: float = 1.0):
        self.trees, self.depth, self.rate, self.l2, self.least = trees, depth, rate, l2, least
        self.base = 0.0
        self.feature = np.zeros((0, (1 << depth) - 1), np.int32)
        self.bound = np.zeros((0, (1 << depth) - 1), np.uint8)
        self.leaf = np.zeros((0, 1 << depth))

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        n, m = x.shape
        bins = int(x.max(initial=1)) + 1
        wide = np.flatnonzero(x.max(0, initial=0) > 1)        # the others are 0 or 1
        flags = (x > 0).astype(np.float32)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        total = np.full(n, self.base)
        features, bounds, leaves = [], [], []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-total))
            g, h = p - y, p * (1 - p)
            node = np.zeros(n, np.int64)
            feature, bound = np.zeros((1 << self.depth) - 1, np.int32), np.full((1 << self.depth) - 1, 255, np.uint8)
            for level in range(self.depth):
                k = 1 << level
                sums = []
                for v in (g, h):
                    one = np.zeros((n, k), np.float32)
                    one[np.arange(n), node] = v
                    above = flags.T @ one                     # feature x node: sum where it is over 0
                    whole = np.bincount(node, v, k)
                    left = np.repeat((whole[None] - above)[:, None, :], bins - 1, 1)   # feature x bound x node
                    for f in wide:
                        per = np.bincount(x[:, f].astype(np.int64) * k + node, v, bins * k).reshape(bins, k)
                        left[f] = np.cumsum(per, 0)[:-1]
                    sums.append((left, whole))
                (gl, gw), (hl, hw) = sums
                gr, hr = gw - gl, hw - hl
                gain = gl**2 / (hl + self.l2) + gr**2 / (hr + self.l2) - gw**2 / (hw + self.l2)
                gain[(hl < self.least) | (hr < self.least)] = -1
                flat = gain.reshape(-1, k)
                best = flat.argmax(0)
                start = k - 1
                for j in range(k):
                    if flat[best[j], j] > 1e-6:
                        feature[start + j], bound[start + j] = best[j] // (bins - 1), best[j] % (bins - 1)
                node = 2 * node + (x[np.arange(n), feature[start + node]] > bound[start + node])
            gs, hs = (np.bincount(node, v, 1 << self.depth) for v in (g, h))
            leaf = -self.rate * gs / (hs + self.l2)
            total += leaf[node]
            features.append(feature)
            bounds.append(bound)
            leaves.append(leaf)
        self.feature, self.bound, self.leaf = np.stack(features), np.stack(bounds), np.stack(leaves)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > bound[node])
            total += leaf[node - len(feature)]
        return total
