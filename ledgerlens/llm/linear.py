"""Sparse multinomial logistic regression by follow-the-regularised-leader
(per-coordinate steps, elastic-net penalty), and temperature calibration."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

Row = tuple[np.ndarray, np.ndarray]  # feature numbers (distinct), values


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Weights of ``classes`` x ``features``; coordinate ``features`` is the
    intercept, which is not penalised."""

    def __init__(self, classes: int, features: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.1,
                 l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((classes, features + 1))
        self.n = np.zeros((classes, features + 1))
        self.features = features

    def _weights(self, at) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        l1 = np.where(np.arange(self.features + 1)[at] == self.features, 0.0, self.l1)
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / step)

    def fit(self, rows: Sequence[Row], labels: np.ndarray, epochs: int = 3, seed: int = 7) -> Ftrl:
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in rng.permutation(len(rows)):
                at = np.append(rows[i][0], self.features)
                x = np.append(rows[i][1], 1.0)
                w = self._weights(at)
                p = softmax(w @ x)
                p[labels[i]] -= 1.0
                g = p[:, None] * x
                n = self.n[:, at]
                sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
                self.z[:, at] += g - sigma * w
                self.n[:, at] = n + g * g
        return self

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        """(classes x features weights, intercepts)."""
        w = self._weights(slice(None))
        return w[:, :-1], w[:, -1]


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores that gives held-back rows the best likelihood
    (golden-section search over its logarithm, between 1/4 and 20: rows that
    the model parts without error would else drive it to 0)."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(scores / np.exp(log_t))
        return -float(np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean())

    lo, hi, ratio = np.log(0.25), np.log(20.0), (np.sqrt(5) - 1) / 2
    a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
    fa, fb = loss(a), loss(b)
    while hi - lo > 1e-3:
        if fa <= fb:
            hi, b, fb = b, a, fa
            a = hi - ratio * (hi - lo)
            fa = loss(a)
        else:
            lo, a, fa = a, b, fb
            b = lo + ratio * (hi - lo)
            fb = loss(b)
    return float(np.exp((lo + hi) / 2))
