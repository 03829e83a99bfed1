"""Gradient-boosted trees on binned dense features, and isotonic calibration; numpy on bounded training tables."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Boosted:
    """Trees of one depth, as arrays: at node k of a tree rows with x[feature] > cut go to 2k + 2, others to 2k + 1."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        row, inner = np.arange(len(x)), self.feature.shape[1]
        for f, c, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (x[row, f[at]] > c[at])
            out += leaf[at - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0, least: float = 0.1) -> Boosted:
    """Logistic loss, second-order gain, cuts at quantiles; a leaf holds that least weight (sum of p (1 - p)), so that a
    few rows of the rarer class can make one on small tables."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    code = np.stack([np.searchsorted(q, c, side="left") for q, c in zip(cuts, x.T, strict=True)])
    p = min(max(y.mean(), 1e-4), 1 - 1e-4)
    start = float(np.log(p / (1 - p)))
    raw, inner = np.full(len(y), start), 2**depth - 1
    feature, cut, leaf = (np.zeros((trees, n)) for n in (inner, inner, inner + 1))
    feature = feature.astype(np.int64)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            node = at - first
            best = np.full(n, 1e-6)
            feature[t, first : first + n], cut[t, first : first + n] = 0, np.inf
            total_g, total_h = np.bincount(node, g, n), np.bincount(node, h, n)
            for f, q in enumerate(cuts):
                if not len(q):
                    continue
                width = len(q) + 1
                gl = np.bincount(node * width + code[f], g, n * width).reshape(n, width).cumsum(1)[:, :-1]
                hl = np.bincount(node * width + code[f], h, n * width).reshape(n, width).cumsum(1)[:, :-1]
                gr, hr = total_g[:, None] - gl, total_h[:, None] - hl
                gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - (total_g**2 / (total_h + l2))[:, None]
                gain[(hl < least) | (hr < least)] = 0
                k = gain.argmax(1)
                better = gain[np.arange(n), k] > best
                best[better] = gain[better, k[better]]
                feature[t, first : first + n][better] = f
                cut[t, first : first + n][better] = q[k[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[t, at]] > cut[t, at])
        node = at - inner
        leaf[t] = -rate * np.bincount(node, g, inner + 1) / (np.bincount(node, h, inner + 1) + l2)
        raw = raw + leaf[t][node]
    return Boosted(start, feature, cut, leaf)


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the nondecreasing fit of y on raw by pooling adjacent violators: values of raw and of the fit, with one
    row of each class added to every pool so that none is certain."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []
    for r, v in zip(raw[order].tolist(), y[order].tolist(), strict=True):
        pools.append([v, 1.0, r])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, n, total = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, pools[-1][2] + total]
    at = np.array([t / n for _, n, t in pools])
    fit = np.array([(s + 0.5) / (n + 1) for s, n, _ in pools])
    return at, np.maximum.accumulate(fit)
