"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.llm.common import remove, sized, written


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (a long, b long); the component is its smallest id.

    Each round points every id to its smallest neighbour, follows the pointers to their ends and
    replaces the edges by edges between ends; loops go. A round at least halves the ids that still
    have edges, so the number of rounds grows with the logarithm of the longest chain. Only
    aggregates and equi-joins run; tables are written to the shared folder, in as many parts as their
    rows need. No edges: no rows. ``edges`` is read twice, so it should be a stored table.
    """
    edges = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = written(sized(edges.distinct(), edges.count()))
    labels = None
    while rows := left.count():
        near = left.union(left.select("b", "a")).groupBy(F.col("a").alias("id"))
        near = near.agg(F.min("b").alias("b")).select("id", F.least("id", "b").alias("root"))
        root = _ends(written(sized(near, 2 * rows)), 2 * rows)
        moved = (
            left.join(root.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a")
            .join(root.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b")
            .filter("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
        after = written(sized(moved, rows))
        remove(left)
        left = after
        labels = root if labels is None else follow(labels, root)
    if labels is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels.select("id", F.col("root").alias("component"))


def follow(labels: DataFrame, root: DataFrame) -> DataFrame:
    """Each label replaced by where ``root`` points it to; both tables go."""
    step = root.select(F.col("id").alias("root"), F.col("root").alias("next"))
    moved = labels.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"))
    out = written(sized(moved, labels.count()))
    remove(labels, root)
    return out


def _ends(root: DataFrame, rows: int) -> DataFrame:
    """Pointers of about ``rows`` ids followed to their ends by doubling."""
    while True:
        step = root.select(F.col("id").alias("root"), F.col("root").alias("next"))
        if root.join(step, "root").filter("next <> root").isEmpty():
            return root
        after = written(sized(root.join(step, "root").select("id", F.col("next").alias("root")), rows))
        remove(root)
        root = after
