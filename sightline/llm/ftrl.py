"""Logistic regression trained by follow-the-regularised-leader updates on sparse rows."""

from __future__ import annotations

import numpy as np


def train(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    size: int,
    epochs: int = 3,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.1,
    seed: int = 0,
) -> np.ndarray:
    """Weights of the features; the last one, at ``size``, belongs to the intercept.

    ``rows`` are (feature numbers without repeats, values, label 0 or 1). The update of
    each coordinate is the closed form of its regularised leader; weights whose leader
    stays within ``l1`` are zero.
    """
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    order = np.random.default_rng(seed)

    def leader(at: np.ndarray) -> np.ndarray:
        strength = np.where(at == size, 0.0, l1)
        far = np.abs(z[at]) > strength
        return np.where(far, -(z[at] - np.sign(z[at]) * strength) / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            features, values, label = rows[k]
            at, x = np.append(features, size), np.append(values, 1.0)
            w = leader(at)
            # A plain sum: the dot product of BLAS would wake its threads for each row.
            g = (sigmoid(float((w * x).sum())) - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return leader(np.arange(size + 1))


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def prior_shift(trained: tuple[int, int], real: tuple[int, int]) -> float:
    """What to add to the log-odds when classes were sampled at other rates.

    The arguments are (rows of label 0, rows of label 1); zero if a class is missing.
    """
    if min(*trained, *real) == 0:
        return 0.0
    return float(np.log(real[1] / real[0]) - np.log(trained[1] / trained[0]))
