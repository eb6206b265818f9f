"""Ordered operators: first row per key and row-based lag."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardlens.sources.tables import snapshot


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    Catalyst limits each group to one row before the shuffle, so a hot key costs one row per
    input partition.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def first_of_newest(
    df: DataFrame, key: str, group: str, newest: str, order: list[str]
) -> DataFrame:
    """One row per key: the first row, in ``order``, of the group that holds the newest row.

    The newest row of a key is the one with the largest ``newest`` (null last), then the first
    in ``order``. Both steps limit every key to one row before they shuffle, so neither a hot key
    nor a hot group needs one task. ``df`` is read twice; pass a stored table.
    """
    newest_first = [F.col(newest).desc_nulls_last(), *order]
    holder = first_per_key(df.select(key, group, newest, *order), [key], newest_first).select(
        F.col(key).alias("_newest_key"), F.col(group).alias("_newest_group")
    )
    same = F.col(key).eqNullSafe(F.col("_newest_key")) & F.col(group).eqNullSafe(F.col("_newest_group"))
    return first_per_key(df.join(holder, same, "left_semi"), [key], order)


def row_lag(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    n: int,
    out: str,
    split_rows: int = 4_000_000,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """Value ``n`` rows earlier within the key; rows with a null key are dropped.

    A first job counts the rows per key (in ``count_from`` if that is cheaper and holds at least
    the same rows). Keys of up to ``split_rows`` rows are sorted in one window. Longer ones are
    range-sorted by key and ``order``, whatever its types, nulls included, into runs of about that
    many rows, but no more runs than ``spark.sql.shuffle.partitions``, and written; each run is sorted in a task of its own, and its first ``n`` rows take
    their value from the last rows of the runs before it. Only rows equal in all of ``order`` share a
    run. Both ways return the same columns.
    """
    rows = df.where(F.col(key).isNotNull())
    counted = rows if count_from is None else count_from.where(F.col(key).isNotNull())
    hot = counted.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > split_rows)
    total = hot.agg(F.sum("_n")).first()[0]
    w = Window.partitionBy(key).orderBy(*order)
    if total is None:
        return rows.withColumn(out, F.lag(value, n).over(w))

    # every run costs the driver a sample, a task and a file: their number must not follow the rows
    runs = min(math.ceil(total / split_rows), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = hot.select(key)
    plain = rows.join(hot, key, "left_anti").withColumn(out, F.lag(value, n).over(w))
    cut = snapshot(
        rows.join(hot, key, "left_semi")
        .repartitionByRange(max(2, runs), key, *order)
        .withColumn("_run", F.spark_partition_id())
    )
    within = Window.partitionBy(key, "_run").orderBy(*order)
    missing = F.size("_carried") - n + F.col("_rn") - 1
    split = (
        cut.withColumns({out: F.lag(value, n).over(within), "_rn": F.row_number().over(within)})
        .join(_carried(cut, key, order, value, n), [key, "_run"], "left")
        .withColumn(out, F.when(F.col("_rn") <= n, F.get("_carried", missing)).otherwise(F.col(out)))
    )
    return plain.select(*df.columns, out).union(split.select(*df.columns, out))


def _carried(rows: DataFrame, key: str, order: list[str], value: str, n: int) -> DataFrame:
    """(key, run, up to ``n`` values that precede the run), oldest first."""
    newest_first = [F.col(c).desc() for c in order]
    back = F.row_number().over(Window.partitionBy(key, "_run").orderBy(*newest_first))
    tails = (
        rows.withColumn("_back", back)
        .where(F.col("_back") <= n)
        .groupBy(key, "_run")
        .agg(F.sort_array(F.collect_list(F.struct(-F.col("_back"), F.col(value)))).alias("_tail"))
        .select(key, "_run", F.col(f"_tail.{value}").alias("_tail"))
    )
    in_order = Window.partitionBy(key).orderBy("_run")
    nothing = F.slice("_tail", 1, 0)
    earlier = [F.coalesce(F.lag("_tail", i).over(in_order), nothing) for i in range(n, 0, -1)]
    return tails.select(key, "_run", F.concat(*earlier).alias("_carried"))
