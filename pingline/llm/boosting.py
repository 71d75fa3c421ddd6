"""Gradient-boosted trees for two classes on a small table of features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees: feature and threshold per inner node, value per leaf."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of the class 1."""
        out = np.full(len(rows), self.base)
        depth = int(np.log2(self.value.shape[1]))
        every = np.arange(len(rows))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (rows[every, feature[at]] > threshold[at])
            out += value[at - len(feature)]
        return out


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 120, depth: int = 4, bins: int = 32, rate: float = 0.2,
        ridge: float = 1.0, least: float = 2.0, share: float = 0.35, seed: int = 3) -> Trees:
    """Newton boosting of the logistic loss on binned features. Each tree sees a random share
    of the features, so that no single clue decides alone."""
    pick = np.random.RandomState(seed)
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(c, rows[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    rate_of = labels.mean().clip(1e-6, 1 - 1e-6)
    base = float(np.log(rate_of / (1 - rate_of)))
    score = np.full(len(rows), base)
    inner = (1 << depth) - 1
    made: tuple[list, list, list] = ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = labels - p, np.maximum(p * (1 - p), 1e-9)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        cut = np.full(inner, bins + 1)
        at = np.zeros(len(rows), np.int64)
        seen = [f for f in pick.permutation(len(cuts))[: max(1, round(share * len(cuts)))].tolist() if len(cuts[f])]
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.full(width, 1e-9)
            for f in seen:
                c = cuts[f]
                k = len(c) + 1
                key = (at - first) * k + binned[:, f]
                g = np.bincount(key, grad, width * k).reshape(width, k)
                h = np.bincount(key, hess, width * k).reshape(width, k)
                gl, hl = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
                gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + ridge) + (gt - gl)**2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain[(hl < least / 10) | (ht - hl < least / 10)] = 0
                top = gain.argmax(1)
                better = gain[np.arange(width), top] > best
                best[better] = gain[np.arange(width), top][better]
                feature[first:first + width][better] = f
                threshold[first:first + width][better] = c[top[better]]
                cut[first:first + width][better] = top[better]
            at = 2 * at + 1 + (binned[np.arange(len(rows)), feature[at]] > cut[at])
        leaf = at - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        value = rate * g / (h + ridge)
        score += value[leaf]
        for kept, new in zip(made, (feature, threshold, value)):
            kept.append(new)
    return Trees(base, *(np.array(x) for x in made))
