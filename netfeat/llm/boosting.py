"""Histogram gradient-boosted trees for a 0/1 label, flattened into arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Node k of tree t stands at t * nodes + k: ``feature`` (-1 in a leaf), ``threshold``
    (to the left up to and with it), ``child`` (the left one; the right one follows), ``value``."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves of each row: all rows and all trees go down a level at a time."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            right = x[row, np.maximum(f, 0)] > self.threshold[at]
            at = np.where(f >= 0, self.child[at] + right, at)
        return self.base + self.value[at].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    least: int = 10, ridge: float = 1.0,
) -> Trees:
    """Logistic loss, second-order gains, splits between at most ``bins`` quantiles of a feature."""
    n, d = x.shape
    if n == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (n + 1) if n else 0.5
        return Trees(np.zeros(1, np.int64), np.full(1, -1), np.zeros(1), np.zeros(1, np.int64), np.zeros(1), 0, float(np.log(share / (1 - share))))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    cell = binned + np.arange(d) * bins
    share = float(y.mean())
    base = float(np.log(share / (1 - share)))
    raw = np.full(n, base)
    roots, feature, threshold, child, value = [], [], [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        roots.append(len(feature))
        level = [(len(feature), np.arange(n))]
        feature.append(-1), threshold.append(0.0), child.append(0), value.append(0.0)
        for step in range(depth + 1):
            after = []
            for node, rows in level:
                g, h = grad[rows].sum(), hess[rows].sum()
                value[node] = -rate * g / (h + ridge)
                best = None
                if step < depth and len(rows) >= 2 * least:
                    cells = cell[rows].ravel()
                    hg = np.bincount(cells, np.repeat(grad[rows], d), bins * d).reshape(d, bins).cumsum(axis=1)
                    hh = np.bincount(cells, np.repeat(hess[rows], d), bins * d).reshape(d, bins).cumsum(axis=1)
                    hn = np.bincount(cells, minlength=bins * d).reshape(d, bins).cumsum(axis=1)
                    gain = hg**2 / (hh + ridge) + (g - hg) ** 2 / (h - hh + ridge) - g**2 / (h + ridge)
                    gain[(hn < least) | (len(rows) - hn < least)] = 0
                    j, k = np.unravel_index(int(np.argmax(gain)), gain.shape)
                    if gain[j, k] > 1e-6 and k < len(cuts[j]):
                        best = j, k
                if best is None:
                    raw[rows] += value[node]
                    continue
                j, k = best
                feature[node], threshold[node], child[node] = int(j), float(cuts[j][k]), len(feature)
                left = binned[rows, j] <= k
                for part in (rows[left], rows[~left]):
                    after.append((len(feature), part))
                    feature.append(-1), threshold.append(0.0), child.append(0), value.append(0.0)
            level = after
    return Trees(*map(np.array, (roots, feature, threshold, child, value)), depth, base)
