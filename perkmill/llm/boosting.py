"""Gradient-boosted trees for two classes, in numpy: logistic loss, binned features, complete trees."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    trees: int = 60
    depth: int = 4
    rate: float = 0.25
    bins: int = 32
    penalty: float = 1.0
    start: float = 0.0
    #: For each tree the feature and threshold of each inner node (heap order), and its leaves' values.
    splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        n, f = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(f)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        slots = binned + np.arange(f) * self.bins
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        score = np.full(n, self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            inner = 2**self.depth - 1
            feature, threshold, at = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(n, int)
            for level in range(self.depth):
                first, width = 2**level - 1, 2**level
                place = ((at - first) * f * self.bins)[:, None] + slots
                sums = [np.bincount(place.ravel(), np.repeat(v, f), width * f * self.bins).reshape(width, f, self.bins).cumsum(axis=2) for v in (g, h)]
                left_g, left_h = sums[0][:, :, :-1], sums[1][:, :, :-1]
                all_g, all_h = sums[0][:, :, -1:], sums[1][:, :, -1:]
                gain = left_g**2 / (left_h + self.penalty) + (all_g - left_g) ** 2 / (all_h - left_h + self.penalty) - all_g**2 / (all_h + self.penalty)
                for j, e in enumerate(edges):  # a bin past the last edge can't be split off
                    gain[:, j, len(e) :] = 0
                best = gain.reshape(width, -1).argmax(axis=1)
                for i, b in enumerate(best):
                    j, k = divmod(int(b), self.bins - 1)
                    if gain[i, j, k] > 1e-9:
                        feature[first + i], threshold[first + i] = j, edges[j][k]
                at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
            leaf = at - inner
            size = 2**self.depth
            value = self.rate * np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + self.penalty)
            self.splits.append((feature, threshold, value))
            score += value[leaf]
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, value in self.splits:
            at = np.zeros(len(x), int)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            score += value[at - len(feature)]
        return score
