"""Linear hinge-loss model by dual coordinate descent, and probability scaling.

Both run on the driver on a bounded sample of labelled rows.
"""

from __future__ import annotations

import numpy as np

#: Rows whose crc32 of the id is divisible by this are held out from learning.
HELD_OUT = 5


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int,
                            cost: np.ndarray, epochs: int = 20, tol: float = 1e-3) -> np.ndarray:
    """Weights of min ||w||^2 / 2 + sum cost_i * max(0, 1 - y_i w.x_i).

    ``rows`` are sparse rows (columns, values) and y is -1 or 1. Each step solves
    one dual variable exactly; an epoch visits the rows in a new fixed order.
    """
    w = np.zeros(size)
    alpha = np.zeros(len(rows))
    square = np.array([v @ v for _, v in rows])
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            if square[i] == 0:
                continue
            at, x = rows[i]
            gradient = y[i] * (w[at] @ x) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * y[i] * x
                worst = max(worst, abs(new - alpha[i]) * square[i])
                alpha[i] = new
        if worst < tol:
            break
    return w


def fit_scaling(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (never negative) and offset of a logistic curve, by Newton steps.

    Targets are smoothed as in Platt scaling, so separable margins stay finite.
    """
    n1, n0 = (weight * (y > 0)).sum(), (weight * (y <= 0)).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    middle, spread = margin.mean(), margin.std() or 1.0
    x = np.stack([(margin - middle) / spread, np.ones_like(margin)], 1)

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float((weight * (np.logaddexp(0, z) - target * z)).sum() + 5e-4 * b @ b)

    b = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (weight * (p - target)) + 1e-3 * b
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        while loss(b - step) > loss(b) and np.abs(step).max() > 1e-9:
            step /= 2
        b = b - step
        if np.abs(step).max() < 1e-6:
            break
    slope = max(float(b[0]) / spread, 1e-6)
    return slope, float(b[1]) - slope * middle


def probability(margin: np.ndarray, slope: float, offset: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
