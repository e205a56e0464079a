"""Logistic regression on a bounded sample in memory."""

from __future__ import annotations

import numpy as np


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Weights (the last one the intercept) by damped Newton steps; ``ridge`` does not touch the
    intercept. With one class only, the intercept is that of a count smoothed by one half."""
    n, d = x.shape
    w = np.zeros(d + 1)
    s = np.ones(n) if weight is None else weight
    pos = float((s * y).sum())
    w[d] = np.log((pos + 0.5) / (float(s.sum()) - pos + 0.5))
    if not 0 < pos < float(s.sum()):
        return w
    z = np.hstack([x, np.ones((n, 1))])
    pen = np.full(d + 1, ridge * max(1.0, float(s.sum())))
    pen[d] = 1e-9

    def loss(w: np.ndarray) -> float:
        m = z @ w
        return float((s * (np.logaddexp(0, m) - y * m)).sum() + 0.5 * (pen * w * w).sum())

    now = loss(w)
    for _ in range(rounds):
        p = sigmoid(z @ w)
        g = z.T @ (s * (p - y)) + pen * w
        h = (z * (s * p * (1 - p))[:, None]).T @ z + np.diag(pen + 1e-8)
        step = np.linalg.solve(h, g)
        t = 1.0
        while (new := loss(w - t * step)) > now and t > 1e-6:
            t /= 2
        if now - new < 1e-9 * (1 + abs(now)):
            break
        w, now = w - t * step, new
    return w


def sigmoid(m: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(m, -60, 60)))
