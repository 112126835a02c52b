"""Fitting small models: the data stays in a Spark table, each step sums one gradient over its partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def summed(table: DataFrame, part: Callable[[pd.DataFrame], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``part`` over the table's batches; one vector of ``size`` numbers comes from each task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for frame in frames:
            total += part(frame)
        yield pd.DataFrame({"sums": [total]})

    rows = table.mapInPandas(run, "sums array<double>").collect()
    return np.sum([row["sums"] for row in rows], axis=0) if rows else np.zeros(size)


def minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int = 25) -> np.ndarray:
    """Limited-memory quasi-Newton steps, each halved until the loss falls enough."""
    x = start.copy()
    value, slope = loss(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, parts = slope.copy(), []
        for s, y in reversed(moves):
            a = s @ way / (s @ y)
            way -= a * y
            parts.append(a)
        if moves:
            s, y = moves[-1]
            way *= (s @ y) / (y @ y)
        else:
            way /= max(1.0, np.linalg.norm(way))
        for (s, y), a in zip(moves, reversed(parts)):
            way += s * (a - y @ way / (s @ y))
        size = 1.0
        for _ in range(12):
            ahead, ahead_slope = loss(x - size * way)
            if ahead <= value - 1e-4 * size * (slope @ way):
                break
            size /= 2
        else:
            return x
        s, y = -size * way, ahead_slope - slope
        x, fell, value, slope = x - size * way, value - ahead, ahead, ahead_slope
        if s @ y > 1e-12:
            moves = [*moves[-7:], (s, y)]
        if fell < 1e-6 * max(1.0, abs(value)):
            break
    return x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3) -> np.ndarray:
    """Weights and a last constant term for a small table on the driver; ``y`` may be probabilities."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(x)) if weight is None else weight

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.clip(x @ w, -60, 60)
        total = max(1.0, weight.sum())
        value = (weight * (np.logaddexp(0, z) - y * z)).sum() / total + ridge * (w[:-1] @ w[:-1])
        return value, x.T @ (weight * (sigmoid(z) - y)) / total + 2 * ridge * np.append(w[:-1], 0)

    return minimise(loss, np.zeros(x.shape[1]), 100)
