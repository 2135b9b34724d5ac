"""What the learned filters share: the rows they may learn from, a bounded sample, logistic fits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(folds: int, fold: int) -> Column:
    """Rows whose crc32 of the doc_id as text leaves ``fold``; a null doc_id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def sample(labels: DataFrame, mark: str, folds: int, fold: int, size: int) -> DataFrame:
    """At most ``size`` labelled rows outside the held-out fold, chosen by a hash of the doc_id.

    Its size is fixed, so the result may be broadcast.  Rows without doc_id or label are left out; of rows that
    repeat a doc_id one label counts, the larger.
    """
    known = labels.filter(~held_out(folds, fold) & F.col("doc_id").isNotNull() & F.col(mark).isNotNull())
    known = known.groupBy("doc_id").agg(F.max(mark).cast("int").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, steps: int = 25) -> np.ndarray:
    """Newton steps of an L2-penalised logistic loss against soft labels."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + ridge * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        move = np.linalg.solve(curve, gradient)
        w -= move * min(1.0, 5 / max(1e-9, float(np.abs(move).max())))
        if np.abs(move).max() < 1e-6:
            break
    return w


def calibrated(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn a margin into the probability of a label."""
    scale = max(1e-9, float(margin.std()))
    x = np.stack([(margin - margin.mean()) / scale, np.ones(len(margin))], axis=1)
    slope, shift = logistic(x, y.astype(float), np.ones(len(y)), 1e-2)
    slope = max(float(slope), 0.0)
    return slope / scale, float(shift) - slope * float(margin.mean()) / scale
