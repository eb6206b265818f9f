"""Sparse multinomial logistic regression: follow the regularised leader, then a temperature."""

from __future__ import annotations

import numpy as np

Row = tuple[np.ndarray, np.ndarray]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(
    rows: list[Row], labels: np.ndarray, weights: np.ndarray, size: int, classes: int,
    alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, epochs: int = 3, seed: int = 11,
) -> np.ndarray:
    """Weights (size + 1, classes), the last row the bias; many are exactly zero.

    FTRL-proximal with a learning rate for each weight; l1 and l2 are the elastic net.
    """
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))

    def weight(at) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) > l1, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x = np.append(rows[i][0], size), np.append(rows[i][1], 1.0)
            w = weight(at)
            p = softmax(x @ w)
            p[labels[i]] -= 1
            g = weights[i] * x[:, None] * p
            old = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - old) / alpha * w
    return weight(slice(None))


def logits(rows: list[Row], w: np.ndarray) -> np.ndarray:
    return np.array([x @ w[at] + w[-1] for at, x in rows]).reshape(len(rows), w.shape[1])


def temperature(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden section; 1 without rows."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(scores / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-(weights * np.log(np.maximum(p, 1e-12))).sum())

    lo, hi, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    while hi - lo > 1e-3:
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))
