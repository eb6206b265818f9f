"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all documents that may be learned from; the weights are fitted by
FTRL with an elastic net on a bounded sample of them, and a part of the sample that the fit has not seen
sets the temperature of the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.llm import ftrl
from boardlens.llm.common import held_out, map_rows, remove, written
from boardlens.llm.fitting import labelled_sample, part_of
from boardlens.llm.ngrams import Counter

ORDERS = range(1, 4)
BITS = 15
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter (Unicode category L)."""
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray
    divisor: float

    def features(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        x = (1 + np.log(count)) * self.idf[at]
        return x / (np.sqrt(x @ x) or 1.0)

    def predict(self, text: str | None, counter: Counter) -> tuple[str, float]:
        if not self.classes or not has_letter(text):
            return UNKNOWN, 0.0
        at, count = counter(text.lower())
        p = ftrl.softmax((self.features(at, count) @ self.weights[at] + self.weights[-1]) / self.divisor)
        best = int(p.argmax())
        return self.classes[best], float(p[best])


def _gather(docs: DataFrame) -> DataFrame:
    """Document frequencies of each task, and the counts of the sampled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, df = Counter(ORDERS, BITS), np.zeros(1 << BITS, np.int64)

        def rows(bucket, n, ids, labels, weights, at, count):
            columns = (
                pa.array(bucket, pa.int32()), pa.array(n, pa.int64()), pa.array(ids, pa.int64()), pa.array(labels, pa.string()),
                pa.array(weights, pa.float64()), pa.array(at, pa.binary()), pa.array(count, pa.binary()),
            )
            return pa.RecordBatch.from_arrays(list(columns), names=["bucket", "n", "doc_id", "label", "weight", "at", "count"])

        for batch in batches:
            picked = []
            for i, text, label, weight in zip(*((v.as_py() for v in batch.column(c)) for c in ("doc_id", "text", "label", "weight")), strict=True):
                if not has_letter(text):
                    continue
                at, count = counter(text.lower())
                df[at] += 1
                if weight is not None:
                    picked.append((i, label, weight, at.astype("<u2").tobytes(), count.astype("<i8").tobytes()))
            if picked:
                none = [None] * len(picked)
                yield rows(none, none, *map(list, zip(*picked, strict=True)))
        at = np.flatnonzero(df)
        none = [None] * len(at)
        yield rows(at, df[at], none, none, none, none, none)

    return docs.mapInArrow(run, "bucket int, n long, doc_id long, label string, weight double, at binary, count binary")


def fit_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_rows: int = 4000) -> LanguageModel:
    """``max_rows`` bounds the sample that the weights are fitted on (about that many rows are chosen)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("label"))
    usable = rows.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = labelled_sample(rows.select("doc_id", "label"), "label", max_rows).dropDuplicates(["doc_id", "label"])
    marked = usable.join(F.broadcast(chosen), ["doc_id", "label"], "left").select("doc_id", "text", "label", "weight")
    got = written(_gather(marked))
    df = np.zeros(1 << BITS)
    for r in got.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[r.bucket] = r.n
    total = usable.filter(F.col("text").isNotNull()).count()
    sample = sorted(got.filter("bucket IS NULL").collect(), key=lambda r: (r.doc_id, r.label, r["at"], r["count"]))
    remove(got)
    classes = sorted({r.label for r in sample})
    idf = np.log((1 + total) / (1 + df)) + 1
    model = LanguageModel(classes, idf.astype(np.float32), np.zeros((1, 1)), 1.0)
    if not sample:
        return model
    features = []
    for r in sample:
        at = np.frombuffer(r["at"], "<u2").astype(np.int64)
        features.append((at, model.features(at, np.frombuffer(r["count"], "<i8"))))
    y = np.array([classes.index(r.label) for r in sample])
    part = part_of([r.doc_id for r in sample])
    fits = (part != 0) if (part != 0).any() and (part == 0).any() else np.ones(len(y), bool)
    train = [features[i] for i in np.flatnonzero(fits)]
    w = ftrl.fit(train, y[fits], np.ones(len(train)), 1 << BITS, len(classes))
    rest = [features[i] for i in np.flatnonzero(~fits)]
    natural = np.array([r.weight for r in sample])[~fits]
    model.divisor = ftrl.temperature(ftrl.logits(rest, w), y[~fits], natural) if rest else 1.0
    model.weights = w.astype(np.float32)
    return model


def identify(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row, from its whole text only.

    Null texts, texts without a letter and a model without classes give ``und`` and 0. Repeated rows give equal
    results; an empty table gives none; other columns don't matter.
    """

    def start():
        counter = Counter(ORDERS, BITS)

        def make(columns):
            out = [model.predict(t, counter) for t in columns["text"]]
            return pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())

        return make

    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    return map_rows(rows, "lang_pred string, score double", start, ["doc_id", "held_out"])
