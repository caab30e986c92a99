"""Small pieces of the numpy networks: activations, Adam, and calibration of scores."""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Adam:
    """Adam steps in place; gradients are clipped to a norm of ``clip``."""

    def __init__(self, params: Params, rate: float = 0.005, clip: float = 5.0, decay: float = 0.0):
        self.params, self.rate, self.clip, self.decay, self.t = params, rate, clip, decay, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: Params) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = min(1.0, self.clip / (norm + 1e-9))
        for k, g in grads.items():
            g = g * scale + self.decay * self.params[k]
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)


def log_loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits)) if len(y) else 0.0


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature between 1/8 and 8 under which the logits have the least log loss."""
    grid = np.exp(np.linspace(-np.log(8), np.log(8), 97))
    return float(min(grid, key=lambda t: log_loss(logits / t, y))) if len(y) else 1.0


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of a slightly regularized logistic regression with intercept (last), by Newton's method."""
    a = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = sigmoid(a @ w)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w)), a.T @ (p - y) + 1e-2 * w)
        w -= np.clip(step, -5, 5)
    return w


def constant_logit(y: np.ndarray) -> float:
    """The logit of the smoothed share of ones, for labels of a single class or none."""
    return float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
