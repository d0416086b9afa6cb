"""Histogram gradient-boosted trees for two classes, stored as flat arrays.

Trees are complete binary trees of one depth. Node ``i`` has children ``2i + 1`` and ``2i + 2``, so
a forest is three arrays (feature, threshold, leaf value), and scoring walks all rows of a batch
down one level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    features: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray
    start: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of features."""
        total = np.full(len(rows), self.start)
        every = np.arange(len(rows))
        inner = self.features.shape[1]
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves, strict=True):
            node = np.zeros(len(rows), np.int64)
            while inner and (node[:1] < inner).all() and len(node):
                node = 2 * node + 1 + (rows[every, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(
    rows: np.ndarray, labels: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1,
    bins: int = 64, least: float = 5.0, ridge: float = 1.0,
) -> Forest:
    """Boost on the logistic loss; split gains come from histograms of binned features."""
    inner, width = (1 << depth) - 1, rows.shape[1]
    share = (labels.sum() + 1) / (len(labels) + 2)
    start = float(np.log(share / (1 - share)))
    made = Forest(
        np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), start
    )
    if not len(rows):
        return made
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, j], "left") for j, e in enumerate(edges)], axis=1)
    # One number per feature and bin, so that a level's histograms are one count.
    slots = binned + np.arange(width) * bins
    total = np.full(len(rows), start)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, bend = labels - chance, chance * (1 - chance)
        node = np.zeros(len(rows), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first = (1 << level) - 1
            count = 1 << level
            where = ((node - first)[:, None] * (width * bins) + slots).ravel()
            shape = (count, width, bins)
            size = count * width * bins
            slopes = np.bincount(where, np.repeat(slope, width), size).reshape(shape)
            bends = np.bincount(where, np.repeat(bend, width), size).reshape(shape)
            left, below = slopes.cumsum(2)[:, :, :-1], bends.cumsum(2)[:, :, :-1]
            whole = slopes.sum(2, keepdims=True), bends.sum(2, keepdims=True)
            right, above = whole[0] - left, whole[1] - below
            gain = left**2 / (below + ridge) + right**2 / (above + ridge) - whole[0] ** 2 / (whole[1] + ridge)
            gain[(below < least / 4) | (above < least / 4)] = -1
            flat = gain.reshape(count, -1)
            best = flat.argmax(axis=1)
            for k in range(count):
                j, b = divmod(int(best[k]), bins - 1)
                if flat[k, best[k]] > 1e-6 and b < len(edges[j]):
                    feature[first + k], threshold[first + k] = j, edges[j][b]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[node]] > threshold[node])
        leaf = node - inner
        value = np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, bend, inner + 1) + ridge)
        total += rate * value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(rate * value)
    return Forest(np.array(features), np.array(thresholds), np.array(leaves), start)
