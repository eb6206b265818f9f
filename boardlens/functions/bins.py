"""Right-closed labelled bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inner bin edges of the year-on-year change and the labels between them.
CHANGE_EDGES = [-0.10, -0.03, 0.0, 0.01, 0.02, 0.10]
CHANGE_LABELS = [
    "Significant Decrease",
    "Moderate Decrease",
    "Slight Decrease",
    "Stable",
    "Slight Increase",
    "Moderate Increase",
    "Significant Increase",
]


def label_bins(
    c: Column, edges: list[float] = CHANGE_EDGES, labels: list[str] = CHANGE_LABELS
) -> Column:
    """Label of the ``(low, high]`` bin; null and NaN give null."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than inner edges is needed")
    out = F.when(c.isNull() | F.isnan(c), F.lit(None))
    for edge, label in zip(edges, labels):
        out = out.when(c <= F.lit(edge), label)
    return out.otherwise(labels[-1])


def bin_number(label: Column, labels: list[str] = CHANGE_LABELS) -> Column:
    """Ordinal of a bin label, lowest bin first, starting at 0."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), label).cast("int") - 1
