"""Sparse logistic regression for bounded samples (driver side), on binary features.

Features are scaled by their naive-Bayes log ratio, which lets a few strong
words stand out against thousands of chance ones in small samples.
"""

from __future__ import annotations

import numpy as np


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Logistic:
    """Weights over ``size`` binary features and some dense columns."""

    def __init__(self, size: int, dense: int = 0, l2: float = 1.0, rounds: int = 200):
        self.size, self.l2, self.rounds = size, l2, rounds
        self.w, self.v, self.b = np.zeros(size), np.zeros(dense), 0.0

    def fit(self, row, col, y, dense=None, weight=None, centre: float = 0.0) -> Logistic:
        """``row``, ``col``: the set features of ``len(y)`` samples; ``centre``: what the dense columns' weights are drawn to."""
        n = len(y)
        dense = np.zeros((n, 0)) if dense is None else dense
        weight = np.ones(n) if weight is None else weight
        total = weight.sum()
        pos, neg = (weight * y).sum(), (weight * (1 - y)).sum()
        if not pos or not neg:                                  # one class only: its prior
            self.b = float(np.log((pos + 0.5) / (neg + 0.5)))
            return self
        p = np.bincount(col, (weight * y)[row], self.size)
        q = np.bincount(col, (weight * (1 - y))[row], self.size)
        scale = np.log((p + 0.5) / (pos + 1)) - np.log((q + 0.5) / (neg + 1))
        wide = np.sqrt(np.maximum(1e-12, (scale[col] ** 2 * weight[row]).sum() / total))
        scale /= max(1.0, wide)
        values = scale[col]
        theta = np.zeros(self.size + dense.shape[1] + 1)
        theta[self.size:-1], theta[-1] = centre, np.log(pos / neg)
        m, s = np.zeros_like(theta), np.zeros_like(theta)
        for t in range(1, self.rounds + 1):
            w, v, b = theta[:self.size], theta[self.size:-1], theta[-1]
            z = np.bincount(row, values * w[col], n) + dense @ v + b
            g = weight * (sigmoid(z) - y) / total
            grad = np.concatenate([np.bincount(col, values * g[row], self.size) + self.l2 * w / total, dense.T @ g + self.l2 * (v - centre) / total, [g.sum()]])
            m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad ** 2
            theta -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-8)
        self.w, self.v, self.b = theta[:self.size] * scale, theta[self.size:-1], float(theta[-1])
        return self

    def margin(self, row, col, n, dense=None):
        z = np.bincount(row, self.w[col], n) + self.b if len(row) else np.full(n, self.b)
        return z if dense is None or not dense.shape[1] else z + dense @ self.v

    def probability(self, row, col, n, dense=None):
        return sigmoid(self.margin(row, col, n, dense))


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Probability cut with the best F1 on ``y``; 0.5 without positives."""
    if not y.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    k = int(np.argmax(f1))
    after = p[order[k + 1]] if k + 1 < len(p) else 0.0
    return float((p[order[k]] + after) / 2)
