"""Quality scores by naive Bayes support vectors on character n-grams.

The indicators of a text's n-grams are scaled by the log ratio of their counts in the two classes; a
linear model with hinge loss is fitted on them by dual coordinate descent and its margins are turned into
probabilities on rows that the fit has not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.llm.common import held_out, map_rows
from boardlens.llm.fitting import labelled_sample, part_of, platt, sigmoid
from boardlens.llm.ngrams import Marker

ORDERS = range(1, 5)
BITS = 17


def log_count_ratios(rows: list[np.ndarray], positive: np.ndarray, size: int, alpha: float = 1.0) -> np.ndarray:
    p, q = np.full(size, alpha), np.full(size, alpha)
    for at, pos in zip(rows, positive, strict=True):
        (p if pos else q)[at] += 1
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, size: int, epochs: int = 20, tolerance: float = 0.01, seed: int = 3
) -> np.ndarray:
    """Weights (size + 1, the last the bias) of least |w|^2 / 2 + sum cost * hinge; y is 1 or -1.

    Ends when no projected gradient of an epoch is beyond ``tolerance``.
    """
    w, a = np.zeros(size + 1), np.zeros(len(rows))
    norm = np.array([x @ x + 1.0 for _, x in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            g = y[i] * (x @ w[at] + w[-1]) - 1
            if a[i] <= 0:
                g_in = min(g, 0.0)
            elif a[i] >= cost[i]:
                g_in = max(g, 0.0)
            else:
                g_in = g
            worst = max(worst, abs(g_in))
            if g_in:
                new = min(max(a[i] - g / norm[i], 0.0), cost[i])
                step = (new - a[i]) * y[i]
                w[at] += step * x
                w[-1] += step
                a[i] = new
        if worst < tolerance:
            break
    return w


@dataclass
class QualityModel:
    ratio: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, at: np.ndarray) -> float:
        if not len(at):
            return self.bias
        r = self.ratio[at]
        return float(r @ self.weights[at] / (np.sqrt(r @ r) or 1.0) + self.bias)


def _features(docs: DataFrame, chosen: DataFrame, doc_id: str, text: str) -> DataFrame:
    def start():
        marker = Marker(ORDERS, BITS)
        return lambda columns: (pa.array([marker(t or "").astype("<i4").tobytes() for t in columns["text"]], pa.binary()),)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    return map_rows(rows.select("doc_id", "label", "weight", "text"), "at binary", start, ["doc_id", "label", "weight"])


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", max_rows: int = 4000, cost: float = 1.0
) -> QualityModel:
    """``max_rows`` bounds the labelled rows that are learned from; half of them come from each class.

    Without labels of both classes the score is the same for all texts.
    """
    chosen = labelled_sample(labels, label, max_rows).filter("label IN ('0', '1')")
    sample = sorted(_features(docs, chosen, doc_id, text).collect(), key=lambda r: (r.doc_id, r.label, r["at"]))
    rows = [np.frombuffer(r["at"], "<i4") for r in sample]
    positive = np.array([r.label == "1" for r in sample], bool)
    weight = np.array([r.weight for r in sample], float)
    part = part_of([r.doc_id for r in sample])
    size = 1 << BITS
    fits = part != 0
    if len(set(positive[fits])) < 2 or len(set(positive[~fits])) < 2:
        fits = np.ones(len(rows), bool)
    if len(set(positive)) < 2:
        zero = np.zeros(size, np.float32)
        return QualityModel(zero, zero, 0.0, *platt(np.zeros(len(rows)), positive, weight))
    train = np.flatnonzero(fits)
    ratio = log_count_ratios([rows[i] for i in train], positive[train], size)
    scaled = []
    for i in train:
        r = ratio[rows[i]]
        scaled.append((rows[i], r / (np.sqrt(r @ r) or 1.0)))
    y = np.where(positive[train], 1.0, -1.0)
    w = dual_coordinate_descent(scaled, y, np.full(len(train), cost), size)
    model = QualityModel(ratio.astype(np.float32), w[:-1].astype(np.float32), float(w[-1]), 1.0, 0.0)
    rest = np.flatnonzero(~fits) if (~fits).any() else train
    margins = np.array([model.margin(rows[i]) for i in rest])
    model.slope, model.shift = platt(margins, positive[rest], weight[rest])
    return model


def score_quality(docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score for each row, from its whole text only.

    Null texts count as empty; empty texts get the score of the bias. Repeated rows give equal scores; an
    empty table gives none; other columns don't matter.
    """

    def start():
        marker = Marker(ORDERS, BITS)

        def make(columns):
            margins = np.array([model.margin(marker(t or "")) for t in columns["text"]], float)
            return (pa.array(sigmoid(model.slope * margins + model.shift), pa.float64()),)

        return make

    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    return map_rows(rows, "score double", start, ["doc_id", "held_out"])
