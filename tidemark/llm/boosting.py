"""Gradient-boosted trees for binary labels in numpy, with quantile bins; fitted on bounded samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of one depth: a feature and a threshold per inner node, a value per leaf."""

    start: float
    features: np.ndarray  # (trees, inner nodes)
    thresholds: np.ndarray
    leaves: np.ndarray  # (trees, leaves)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds per row."""
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.features.shape[1]
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:  # all rows are at the same level
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += leaf[at - inner]
        return out


def fit_trees(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, *, trees: int = 60, depth: int = 4, rate: float = 0.2,
    bins: int = 16, ridge: float = 1.0,
) -> Trees:
    """Second-order boosting of the logistic loss; a node that no split improves sends all rows left."""
    n, width = x.shape
    w = np.ones(n) if weight is None else weight.astype(float)
    share = float(np.clip((w * y).sum() / max(w.sum(), 1e-9), 1e-3, 1 - 1e-3))
    inner, last = (1 << depth) - 1, 1 << depth
    model = Trees(float(np.log(share / (1 - share))), np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, last)))
    if not n:
        return model
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    code = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    flat = code + np.arange(width) * bins
    margin = np.full(n, model.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (y - p), w * p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = (1 << level) - 1, 1 << level
            place = ((at - first)[:, None] * (width * bins) + flat).ravel()
            sums = [np.bincount(place, np.repeat(v, width), nodes * width * bins).reshape(nodes, width, bins) for v in (g, h)]
            left_g, left_h = (np.cumsum(s, 2) for s in sums)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            gain = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g**2 / (all_h + ridge)
            gain[:, :, -1] = 0
            for f, e in enumerate(edges):
                gain[:, f, len(e) :] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            feature, cut = best // bins, best % bins
            good = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            model.features[t, first : first + nodes] = feature
            model.thresholds[t, first : first + nodes] = [edges[f][c] if ok else np.inf for f, c, ok in zip(feature, cut, good)]
            node = at - first
            right = good[node] & (code[np.arange(n), feature[node]] > cut[node])
            at = 2 * at + 1 + right
        leaf = at - inner
        value = rate * np.bincount(leaf, g, last) / (np.bincount(leaf, h, last) + ridge)
        model.leaves[t] = value
        margin += value[leaf]
    return model
