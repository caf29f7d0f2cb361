"""Small linear models, fitted on the driver from bounded samples."""

from __future__ import annotations

import numpy as np


class Rows:
    """Sparse rows as flat arrays: entry k is ``value[k]`` in (row[k], column[k])."""

    def __init__(self, row, column, value, n_rows: int, n_columns: int):
        self.row, self.column = np.asarray(row, np.int64), np.asarray(column, np.int64)
        self.value = np.asarray(value, np.float64)
        self.n_rows, self.n_columns = n_rows, n_columns

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.column], self.n_rows)

    def summed(self, per_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * per_row[self.row], self.n_columns)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(np.asarray(x) / 2))


def fit_logistic(
    x: Rows,
    target: np.ndarray,
    weight: np.ndarray | None = None,
    l1: float = 1e-4,
    l2: float = 1e-4,
    rounds: int = 400,
) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on targets between 0 and 1.

    Accelerated proximal gradient steps; columns are scaled by their mean square, the
    intercept is not penalised.
    """
    weight = np.ones(x.n_rows) if weight is None else weight
    weight = weight / weight.sum()
    scale = np.sqrt(np.maximum(np.bincount(x.column, x.value**2 * weight[x.row], x.n_columns), 1e-12))
    scaled = Rows(x.row, x.column, x.value / scale[x.column], x.n_rows, x.n_columns)
    # The curvature is at most a quarter of the largest eigenvalue of the second moments.
    probe, top = np.ones(x.n_columns) / np.sqrt(max(x.n_columns, 1)), 1.0
    for _ in range(20):
        image = scaled.summed(weight * scaled.times(probe))
        top = max(float(np.linalg.norm(image)), 1e-12)
        probe = image / top
    step = 1 / (0.25 * (1.2 * top + 1) + l2)
    w = v = np.zeros(x.n_columns)
    mean = float(np.clip((weight * target).sum(), 1e-4, 1 - 1e-4))
    b = c = np.log(mean / (1 - mean))
    t = 1.0
    for _ in range(rounds):
        error = weight * (sigmoid(scaled.times(v) + c) - target)
        moved = v - step * (scaled.summed(error) + l2 * v)
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
        new_b = c - step * error.sum()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return w / scale, float(b)
