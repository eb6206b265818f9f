"""Join operators beyond a plain equi-join.

No side is force-broadcast: Spark broadcasts a side whose measured size is below
``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits skewed partitions of the
sort-merge joins beyond that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _renamed(right: DataFrame, keys: list[str]) -> DataFrame:
    return right.withColumnsRenamed({k: f"_r_{k}" for k in keys})


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def null_safe_left(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which a null key matches a null key."""
    r = _renamed(right, keys)
    on = _all([F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(r, on, "left").drop(*[f"_r_{k}" for k in keys])


def inner_on(
    left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """Inner join on one key; other shared names get the suffixes."""
    shared = [c for c in left.columns if c in right.columns and c != key]
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return left.join(right, key, "inner")


def keep_matching(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose keys occur in ``right``."""
    return left.join(right, keys, "left_semi")


def flag_matching(left: DataFrame, right: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """``left`` with a boolean that tells whether its keys occur in ``right``."""
    hits = right.select(*keys).distinct().withColumn(flag, F.lit(True))
    out = null_safe_left(left, hits, keys)
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def earliest_other(
    df: DataFrame, keys: list[str], is_target: Column, start: Column, out: str
) -> DataFrame:
    """Per keys the earliest start of the rows that are not targets."""
    others = df.where(~is_target & start.isNotNull())
    return others.groupBy(*keys).agg(F.min(start).alias(out))


def preceded_by_other(
    df: DataFrame, keys: list[str], label: str, is_target: Column, start: Column
) -> DataFrame:
    """Distinct (keys, label) of target rows that some non-target row of the same keys precedes.

    A target row started on or after some other row exactly when it started on or after the
    earliest of them, and a label qualifies exactly when its latest start does. So two
    map-side-combined aggregates replace the self join of all row pairs, whatever the group size.
    """
    latest = (
        df.where(is_target & start.isNotNull())
        .groupBy(*keys, label)
        .agg(F.max(start).alias("_latest"))
    )
    return (
        latest.join(earliest_other(df, keys, is_target, start, "_earliest"), keys)
        .where(F.col("_latest") >= F.col("_earliest"))
        .select(*keys, label)
    )
