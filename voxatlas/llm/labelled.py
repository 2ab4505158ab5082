"""Labelled samples of a bounded size, and one-dimensional calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.llm.common import held_out


def sample(labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, y, fold) of at most ``most`` labelled rows of each class, none held out.

    The rows of least hash are taken; ``fold`` is the remainder 1 to 4 of the id's
    crc32 modulo 5.  An id with both labels counts as 1.  The bound makes the result safe
    to broadcast.
    """
    rows = labels.where(~held_out()).where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("double").alias("y"), (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5).cast("int").alias("fold")).groupBy("doc_id", "fold").agg(F.max("y").alias("y")).select("doc_id", "y", "fold")
    parts = [rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for y in (0.0, 1.0)]
    return parts[0].unionAll(parts[1])


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit of y on x: pool adjacent violators."""
    order = np.argsort(x, kind="stable")
    total: list[float] = []
    weight: list[float] = []
    centre: list[float] = []
    for a, b in zip(x[order].tolist(), y[order].tolist(), strict=True):
        total.append(b)
        weight.append(1.0)
        centre.append(a)
        while len(total) > 1 and total[-2] * weight[-1] >= total[-1] * weight[-2]:
            b, w, c = total.pop(), weight.pop(), centre.pop()
            centre[-1] = (centre[-1] * weight[-1] + c * w) / (weight[-1] + w)
            total[-1] += b
            weight[-1] += w
    return np.array(centre), np.array(total) / np.array(weight) if total else np.zeros(0)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, turns: int = 50) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic fit, by Newton steps."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(turns):
        p = sigmoid(z @ w)
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(t: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(t, -40, 40)))
