"""Small linear models in numpy, for bounded samples."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression, the last for a constant, by Newton's method with a ridge (not on the
    constant)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.ones(len(x)) if weight is None else weight
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w -= step * min(1, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-5, rounds: int = 30) -> np.ndarray:
    """Weights of a linear support vector machine, the last for a constant: Newton's method on the squared hinge loss of
    labels -1 and 1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight, penalty = weight / weight.sum(), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-9
    w, last = np.zeros(x.shape[1]), None
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        if last is not None and (inside == last).all():
            break
        part, c, last = x[inside], weight[inside], inside
        w = np.linalg.solve((part * c[:, None]).T @ part + np.diag(penalty), part.T @ (c * y[inside]))
    return w
