"""Gradient-boosted regression trees in numpy, kept as flat node arrays and scored without a Python loop over rows.

Chosen features may be declared monotonic: a split on such a feature is taken only if its right side is not lower, and
the values of its branches are bounded so that no deeper split can break the order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """All trees' nodes in one set of arrays. A leaf's children are itself; ``root``: each tree's first node."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    root: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for r in self.root:
            at = np.full(len(x), r, np.int32)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] > self.threshold[at], self.right[at], self.left[at])
            out += self.value[at]
        return out


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 48, least: int = 8, ridge: float = 1.0, monotonic: tuple[int, ...] = ()) -> Forest:
    """Least-squares boosting on binned features. Deterministic. No rows: a forest that scores 0."""
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    n = len(y)
    base = float(y.mean()) if n else 0.0
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1) if n else np.zeros((0, x.shape[1]), int)
    up = set(monotonic)
    pred = np.full(n, base)

    def node(v: float) -> int:
        i = len(feature)
        feature.append(0)
        threshold.append(np.inf)
        left.append(i)
        right.append(i)
        value.append(v)
        return i

    def grow(rows: np.ndarray, g: np.ndarray, level: int, lo: float, hi: float) -> int:
        total, count = g[rows].sum(), len(rows)
        mine = float(np.clip(total / (count + ridge), lo, hi))
        i = node(mine * rate)
        if level == depth or count < 2 * least:
            pred[rows] += mine * rate
            return i
        best = (1e-9, -1, 0, 0.0, 0.0)
        for j, e in enumerate(edges):
            if not len(e):
                continue
            b = binned[rows, j]
            c = np.bincount(b, minlength=len(e) + 1).cumsum()[:-1]
            s = np.bincount(b, weights=g[rows], minlength=len(e) + 1).cumsum()[:-1]
            vl, vr = s / (c + ridge), (total - s) / (count - c + ridge)
            gain = s * s / (c + ridge) + (total - s) ** 2 / (count - c + ridge) - total * total / (count + ridge)
            ok = (c >= least) & (count - c >= least)
            if j in up:
                ok &= vr >= vl
            gain = np.where(ok, gain, 0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], j, k, vl[k], vr[k])
        _, j, k, vl, vr = best
        if j < 0:
            pred[rows] += mine * rate
            return i
        mid = float(np.clip((vl + vr) / 2, lo, hi))
        go = binned[rows, j] > k
        feature[i], threshold[i] = j, float(edges[j][k])
        bounds = ((lo, mid), (mid, hi)) if j in up else ((lo, hi), (lo, hi))
        left[i] = grow(rows[~go], g, level + 1, *bounds[0])
        right[i] = grow(rows[go], g, level + 1, *bounds[1])
        return i

    for _ in range(trees if n else 0):
        roots.append(grow(np.arange(n), y - pred, 0, -np.inf, np.inf))
    a = lambda v, t: np.asarray(v, t)
    return Forest(a(feature, np.int32), a(threshold, float), a(left, np.int32), a(right, np.int32), a(value, float), a(roots, np.int32), base, depth)
