"""Bounded samples of labelled rows, and calibration of scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.llm.common import held_out

_PARTS = 1 << 20


def labelled_sample(labels: DataFrame, label: str, rows: int, doc_id: str = "doc_id", classes: int | None = None) -> DataFrame:
    """(doc_id, label, weight): about ``rows`` labelled rows, as many of each class as far as there are.

    Held-out rows and null ids and labels are left out. Rows are chosen by a hash of the id, so the choice
    does not depend on partitions; weight is how many rows of its class each stands for. Classes are counted
    over the whole table; the sample is the only thing that is bounded.
    """
    usable = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc_id)))
    usable = usable.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("string").alias("label"))
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    share = {k: min(1.0, rows / len(counts) / n) for k, n in counts.items()}
    if not share:
        return usable.withColumn("weight", F.lit(1.0))
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), F.lit(_PARTS))
    limits = F.create_map(*[F.lit(x) for k, v in share.items() for x in (k, round(v * _PARTS))])
    weight = F.create_map(*[F.lit(x) for k, v in share.items() for x in (k, 1 / v)])
    return usable.filter(part < limits[F.col("label")]).withColumn("weight", weight[F.col("label")])


def part_of(keys: np.ndarray, parts: int = 5) -> np.ndarray:
    """A stable part number of each id."""
    mixed = np.asarray(keys, np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(parts)).astype(int)


def platt(score: np.ndarray, positive: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(a, b) of sigmoid(a * score + b), by Newton steps on smoothed targets.

    With one class only, or none, the result is flat at the smoothed share.
    """
    pos, neg = weight[positive].sum(), weight[~positive].sum()
    flat = float(np.log((pos + 1) / (neg + 1)))
    if not pos or not neg:
        return 0.0, flat
    middle, spread = score.mean(), score.std() or 1.0
    n_pos, n_neg = positive.sum(), (~positive).sum()
    target = np.where(positive, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    x = np.stack([(score - middle) / spread, np.ones(len(score))], axis=1)
    w = np.array([0.0, flat])
    share = weight / weight.sum()

    def loss(v: np.ndarray) -> float:
        m = x @ v
        return float((share * (np.logaddexp(0, m) - target * m)).sum()) + 1e-6 * float(v[0] ** 2)

    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        grad = x.T @ (share * (p - target)) + [2e-6 * w[0], 0]
        hess = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag([2e-6, 1e-9])
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(w[0] / spread), float(w[1] - w[0] * middle / spread)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
