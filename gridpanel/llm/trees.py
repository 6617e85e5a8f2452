"""Gradient-boosted trees in numpy: histogram training, monotonic constraints, flat node arrays.

A model is a handful of arrays with one entry per node; all trees share them.
Scoring walks every row of a batch one level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class FlatTrees:
    """roots[t]: first node of tree t. Leaves point at themselves and carry the value."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    bias: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: np.ndarray,
    rounds: int = 60,
    depth: int = 3,
    rate: float = 0.15,
    bins: int = 48,
    least: float = 8.0,
    ridge: float = 2.0,
) -> FlatTrees:
    """Logistic loss on finite features. monotone: -1, 0 or 1 per feature.

    Without rows of both classes the model is the constant base rate.
    """
    share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    bias = float(np.log(share / (1 - share)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
        raw = np.full(len(y), bias)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-raw))
            roots.append(len(nodes["value"]))
            raw += _grow(binned, edges, p - y, p * (1 - p), monotone, nodes, depth, rate, least, ridge)
    return FlatTrees(*(np.asarray(a, t) for a, t in ((roots, np.int64), *((nodes[k], np.float64 if k in ("threshold", "value") else np.int64) for k in ("feature", "threshold", "left", "right", "value")))), depth, bias)


def _grow(binned, edges, gradient, hessian, monotone, nodes, depth, rate, least, ridge) -> np.ndarray:
    """One tree, added to nodes; returns its value for every training row."""
    step = np.zeros(len(gradient))
    stack = [(np.arange(len(gradient)), 0, -np.inf, np.inf, None)]
    while stack:
        rows, level, low, high, slot = stack.pop()
        me = len(nodes["value"])
        if slot:
            nodes[slot[0]][slot[1]] = me
        g, h = gradient[rows].sum(), hessian[rows].sum()
        value = float(np.clip(-g / (h + ridge), low, high))
        for key, v in (("feature", 0), ("threshold", 0.0), ("left", me), ("right", me), ("value", rate * value)):
            nodes[key].append(v)
        best = _split(binned, edges, rows, gradient, hessian, monotone, low, high, least, ridge, g, h) if level < depth else None
        if best is None:
            step[rows] = rate * value
            continue
        j, cut, wl, wr = best
        nodes["feature"][me], nodes["threshold"][me] = j, float(edges[j][cut])
        goes = binned[rows, j] <= cut
        bounds = [(low, high), (low, high)]
        if monotone[j]:
            middle = (wl + wr) / 2
            bounds = [(low, middle), (middle, high)] if monotone[j] > 0 else [(middle, high), (low, middle)]
        stack.append((rows[~goes], level + 1, *bounds[1], ("right", me)))
        stack.append((rows[goes], level + 1, *bounds[0], ("left", me)))
    return step


def _split(binned, edges, rows, gradient, hessian, monotone, low, high, least, ridge, g, h):
    """Best (feature, last bin of the left side, left value, right value), or None."""
    best, gain = None, 1e-6
    for j, e in enumerate(edges):
        if not len(e):
            continue
        b = binned[rows, j]
        gl = np.cumsum(np.bincount(b, gradient[rows], len(e) + 1))[:-1]
        hl = np.cumsum(np.bincount(b, hessian[rows], len(e) + 1))[:-1]
        gr, hr = g - gl, h - hl
        wl, wr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
        better = -(gl * wl + 0.5 * (hl + ridge) * wl**2) - (gr * wr + 0.5 * (hr + ridge) * wr**2) - 0.5 * g * g / (h + ridge)
        allowed = (hl * 4 >= least) & (hr * 4 >= least) & ((wr - wl) * monotone[j] >= 0)
        better = np.where(allowed, better, -np.inf)
        k = int(np.argmax(better))
        if better[k] > gain:
            best, gain = (j, k, float(wl[k]), float(wr[k])), better[k]
    return best
