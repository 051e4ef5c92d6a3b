"""Gradient-boosted trees in numpy: histogram training on a bounded sample, monotonic constraints, and scoring over
flattened node arrays.

A tree of depth d is a complete binary tree in level order: node i has children 2i + 1 and 2i + 2, a feature and a
threshold; its 2**d leaves hold values.  A batch of rows walks down all together, one array lookup per level, so
scoring costs trees x depth vector operations whatever the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    feature: np.ndarray     # (trees, 2**depth - 1) int
    threshold: np.ndarray   # (trees, 2**depth - 1) float; a row goes right when its value is larger
    value: np.ndarray       # (trees, 2**depth) float
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(int(inner + 1).bit_length() - 1):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def train(x: np.ndarray, y: np.ndarray, monotone, n_trees: int = 40, depth: int = 3, rate: float = 0.2,
          n_bins: int = 64, l2: float = 1.0, min_hessian: float = 1.0) -> Trees:
    """Logistic boosting.  ``monotone[j]``: +1 the score may only rise with feature j, -1 only fall, 0 free.

    A split of a constrained feature is allowed only if its two values are in order, and the values below either side
    are then held on their side of the middle, so the order holds for the whole tree.
    """
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p0 / (1 - p0)))
    score = np.full(n, base)
    inner, leaves = 2 ** depth - 1, 2 ** depth
    feature, threshold, value = [], [], []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        f, t, v = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(leaves)
        at = np.zeros(n, np.int64)
        low, high = np.full(2 * leaves - 1, -np.inf), np.full(2 * leaves - 1, np.inf)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best = _best_split(binned[rows], g[rows], h[rows], edges, monotone, l2, min_hessian, low[node], high[node]) \
                if len(rows) else None
            left, right = 2 * node + 1, 2 * node + 2
            low[[left, right]], high[[left, right]] = low[node], high[node]
            if best:
                j, b, vl, vr = best
                f[node], t[node] = j, edges[j][b]
                if monotone[j]:
                    low_side, high_side = (left, right) if monotone[j] > 0 else (right, left)
                    high[low_side] = low[high_side] = (vl + vr) / 2
                at[rows] = np.where(binned[rows, j] > b, right, left)
            else:
                at[rows] = left
        for leaf in range(leaves):
            rows = np.flatnonzero(at == inner + leaf)
            if len(rows):
                v[leaf] = np.clip(g[rows].sum() / (h[rows].sum() + l2), low[inner + leaf], high[inner + leaf])
            elif np.isfinite(low[inner + leaf]) or np.isfinite(high[inner + leaf]):
                v[leaf] = np.clip(0.0, low[inner + leaf], high[inner + leaf])
        score += rate * v[at - inner]
        feature.append(f), threshold.append(t), value.append(rate * v)
    return Trees(np.array(feature), np.array(threshold), np.array(value), base)


def _best_split(bins, g, h, edges, monotone, l2, min_hessian, low, high):
    total_g, total_h = g.sum(), h.sum()
    gain_of = lambda a, b: a * a / (b + l2)
    best, found = 1e-6, None
    for j, e in enumerate(edges):
        if not len(e):
            continue
        gl = np.cumsum(np.bincount(bins[:, j], g, len(e) + 1))[:-1]
        hl = np.cumsum(np.bincount(bins[:, j], h, len(e) + 1))[:-1]
        gr, hr = total_g - gl, total_h - hl
        gain = gain_of(gl, hl) + gain_of(gr, hr) - gain_of(total_g, total_h)
        vl, vr = np.clip(gl / (hl + l2), low, high), np.clip(gr / (hr + l2), low, high)
        gain[(hl < min_hessian) | (hr < min_hessian) | (monotone[j] * (vr - vl) < 0)] = -np.inf
        b = int(gain.argmax())
        if gain[b] > best:
            best, found = gain[b], (j, b, vl[b], vr[b])
    return found
