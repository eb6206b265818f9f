"""Model frame from the wide table, repeated runs and predictions for every company."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.operators.features import (
    assemble,
    complete_rows,
    fit_labels,
    hash_split,
    labels_back,
    standardise,
)
from boardlens.operators.models import LABEL, Model, accuracy

# Model columns in their order.
NUMERIC = [
    "uniscoreavg", "tenure", "female_pct", "shannon", "num_committees", "dirs", "over75_pct",
    "num_meetings", "avg_meetings",
]
BINARY = [
    "bachelors", "masters", "mba", "phd", "founder", "internal_promotion", "is_co_ceo",
    "diversity_board",
]


@dataclass(frozen=True)
class Prepared:
    """Complete rows with their raw columns, a scaled ``features`` vector and a ``label`` index."""

    frame: DataFrame
    labels: StringIndexerModel


def prepare_features(
    wide: DataFrame,
    key: str = "ticker",
    target: str = "roachange",
    numeric: list[str] = NUMERIC,
    binary: list[str] = BINARY,
    fit_on: str = "all",
    seed: int = 42,
) -> Prepared:
    """Drop incomplete rows, index the target, scale all model columns and assemble them.

    ``fit_on='train'`` takes the scaling moments from the training part only.
    """
    cols = [*numeric, *binary]
    full = complete_rows(wide)
    labels = fit_labels(full, target, LABEL)
    scaled_names = [f"_{c}" for c in cols]
    typed = labels.transform(full).withColumns(
        {f"_{c}": F.col(c).cast("int" if c in binary else "double") for c in cols}
    )
    moments_from = hash_split(typed, key, seed)[0] if fit_on == "train" else None
    frame = assemble(standardise(typed, scaled_names, moments_from), scaled_names)
    return Prepared(frame.drop(*scaled_names), labels)


def score_all(
    prepared: Prepared,
    model: Model,
    key: str = "ticker",
    target: str = "roachange",
    out: str = "roapredicted",
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(all rows with the predicted label in place of the target, hold-out accuracy)."""
    train, test = hash_split(prepared.frame, key, seed)
    fitted = model.fit(train)
    named = labels_back(prepared.labels, "prediction", out)
    final = named.transform(model.predict(fitted, prepared.frame))
    return (
        final.drop("features", LABEL, "prediction", target),
        accuracy(model.predict(fitted, test)),
    )
