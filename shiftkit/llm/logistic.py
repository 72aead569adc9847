"""Logistic regression for calibrating a few score features on a bounded sample."""

from __future__ import annotations

import numpy as np


def expand(f: np.ndarray) -> np.ndarray:
    """The features and their pairwise products."""
    n = f.shape[1]
    return np.hstack([f] + [f[:, i:i + 1] * f[:, i:] for i in range(n)])


class Logistic:
    """Ridge-regularised logistic regression fitted by Newton steps.

    A full step may overshoot where the labels are almost separable: it is
    halved until the penalised likelihood rises enough.  The likelihood has one
    maximum, so the steps end there from any start.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 100):
        x = expand(np.asarray(x, float))
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = self._design(x)
        sign = np.where(y == 1, -1.0, 1.0)

        def loss(b: np.ndarray) -> float:
            return float(weight @ np.logaddexp(0, sign * (z @ b)) + ridge / 2 * (b @ b))

        self.b = np.zeros(z.shape[1])
        now = loss(self.b)
        for _ in range(steps):
            p = self._prob(z)
            v = weight * p * (1 - p) + 1e-9
            grad = z.T @ (weight * (y - p)) - ridge * self.b
            step = np.linalg.solve((z * v[:, None]).T @ z + ridge * np.eye(len(self.b)), grad)
            rise, size = float(grad @ step), 1.0
            while size > 1e-9 and not loss(self.b + size * step) <= now - 1e-4 * size * rise:
                size /= 2
            if size <= 1e-9:                    # no step rises: at the maximum, but for rounding
                break
            self.b = self.b + size * step
            now = loss(self.b)

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])

    def _prob(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z @ self.b, -35, 35)))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self._prob(self._design(expand(np.asarray(x, float))))
