"""Small linear models, fitted on the driver over bounded samples."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 200, weight: np.ndarray | None = None) -> np.ndarray:
    """Weights (bias last) of a logistic regression, by Nesterov's accelerated gradient.

    Deterministic. With one class only, the weights are zero and the bias is that class."""
    n, d = x.shape
    w = np.zeros(d + 1)
    if n == 0:
        return w
    s = np.ones(n) if weight is None else weight
    s = s / s.sum()
    rate = float((s * y).sum())
    if rate <= 0 or rate >= 1:
        w[-1] = 6.0 if rate >= 1 else -6.0
        return w
    w[-1] = np.log(rate / (1 - rate))
    v = np.random.default_rng(0).standard_normal(d).astype(x.dtype)  # largest curvature by power iteration
    for _ in range(12):
        v = x.T @ (s.astype(x.dtype) * (x @ v))
        norm = float(np.linalg.norm(v)) or 1.0
        v /= norm
    step = 1.0 / (0.25 * (1.1 * norm + 1.0) + l2)
    look, before, t = w.copy(), w.copy(), 1.0
    for _ in range(steps):
        p = sigmoid(x @ look[:-1].astype(x.dtype) + look[-1])
        g = s * (p - y)
        grad = np.append(x.T @ g.astype(x.dtype), g.sum())
        grad[:-1] += l2 * look[:-1]
        w = look - step * grad
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look = w + (t - 1) / t_next * (w - before)
        before, t = w, t_next
    return w


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1].astype(x.dtype) + w[-1])


def out_of_fold(x: np.ndarray, y: np.ndarray, fold: np.ndarray, l2: float, steps: int = 200, more: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Probability of each row by a model that has not seen its fold; ``more`` is always seen."""
    p = np.zeros(len(y))
    for k in np.unique(fold):
        seen = fold != k
        a, b = (x[seen], y[seen]) if more is None else (np.concatenate([x[seen], more[0]]), np.concatenate([y[seen], more[1]]))
        p[~seen] = predict(x[~seen], fit_logistic(a, b, l2, steps))
    return p
