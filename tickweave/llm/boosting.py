"""Histogram gradient-boosted trees for two classes, and their flat form."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
RIDGE = 1.0
LEAST_ROWS = 20  # rows of a leaf


@dataclass
class Trees:
    """All nodes of all trees in arrays. A leaf is its own child, so that every row takes
    ``DEPTH`` steps and a batch goes down all trees at once."""

    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of ``x``."""
        at = np.repeat(self.root[None], len(x), 0)
        for _ in range(DEPTH):
            goes_left = np.take_along_axis(x, self.feature[at], 1) <= self.threshold[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(1))))


def _edges(x: np.ndarray) -> list[np.ndarray]:
    points = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.quantile(column, points, method="lower")) for column in x.T]


def _histogram(binned, rows, weights):
    n, features = len(rows), binned.shape[1]
    flat = (binned[rows] + np.arange(features) * BINS).ravel()
    return np.bincount(flat, np.repeat(weights[rows], features) if n else None, features * BINS).reshape(features, BINS)


def _best_split(binned, rows, grad, hess):
    g, h = _histogram(binned, rows, grad), _histogram(binned, rows, hess)
    n = _histogram(binned, rows, np.ones(len(grad)))
    gl, hl, nl = (np.cumsum(a, 1)[:, :-1] for a in (g, h, n))
    gt, ht, nt = g.sum(1, keepdims=True), h.sum(1, keepdims=True), n.sum(1, keepdims=True)
    gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
    gain[(nl < LEAST_ROWS) | (nt - nl < LEAST_ROWS)] = 0
    feature, split = np.unravel_index(np.argmax(gain), gain.shape)
    return (feature, split) if gain[feature, split] > 1e-6 else None


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for rows ``x`` and labels ``y``. Without rows every score is 0.5; with one
    class alone it is near that class."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    root, nodes = [], []  # a node: feature, threshold, left, right, value
    if len(y):
        edges = _edges(x)
        binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], 1)
        margin = np.full(len(y), base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            root.append(len(nodes))
            _grow(nodes, binned, edges, np.arange(len(y)), p - y, p * (1 - p), DEPTH, margin)
    columns = list(zip(*nodes)) or [()] * 5
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return Trees(np.array(root, np.int64), *(np.array(c, k) for c, k in zip(columns, kinds)), base)


def _grow(nodes, binned, edges, rows, grad, hess, depth, margin) -> int:
    at = len(nodes)
    split = _best_split(binned, rows, grad, hess) if depth else None
    if split is None:
        value = -RATE * grad[rows].sum() / (hess[rows].sum() + RIDGE)
        margin[rows] += value
        nodes.append((0, 0.0, at, at, float(value)))
        return at
    nodes.append(None)
    feature, cut = split
    low = binned[rows, feature] <= cut
    left = _grow(nodes, binned, edges, rows[low], grad, hess, depth - 1, margin)
    right = _grow(nodes, binned, edges, rows[~low], grad, hess, depth - 1, margin)
    nodes[at] = (int(feature), float(edges[feature][cut]), left, right, 0.0)
    return at
