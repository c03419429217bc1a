"""What the trained text operators share: folds, bounded samples, logistic regression on a bounded sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a missing id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def bounded(rows: DataFrame, label: str, most: int) -> DataFrame:
    """About `most` rows of each label (all, where there are fewer), chosen by a hash of doc_id: a filter, no shuffle.

    `label` must have few values: their counts are collected.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    hashed = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)).cast("double") / float(1 << 30)
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | ((F.col(label) == F.lit(value)) & (hashed < most / n))
    return rows.filter(keep)


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features, outputs) and intercepts of independent logistic regressions on targets y in {0, 1}.

    Accelerated gradient steps of a fixed number from zero: the same data give the same model.
    """
    n, d = x.shape
    one = np.concatenate([x, np.ones((n, 1), x.dtype)], axis=1)
    w = v = np.zeros((d + 1, y.shape[1]), x.dtype)
    rate = 4 / max(float((one ** 2).sum(1).max()), 1e-9)
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(one @ v, -30, 30)))
        grad = one.T @ (p - y) / n
        grad[:-1] += penalty * v[:-1]
        new = v - rate * grad
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w[:-1], w[-1]
