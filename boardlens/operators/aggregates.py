"""Grouped aggregates. All of them combine on the map side before they shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlens.operators.windows import first_per_key


def distinct_counts(
    df: DataFrame, keys: list[str], counts: dict[str, str], approximate: bool = False
) -> DataFrame:
    """Distinct count of several columns per group, null keys kept."""
    fn = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(*keys).agg(*[fn(F.col(c)).alias(out) for out, c in counts.items()])


def integer_share(flag: str, exact: bool = False) -> Column:
    """Sum over count of a 0/1 column; integer division unless ``exact``."""
    return F.expr(f"sum({flag}) {'/' if exact else 'div'} count({flag})")


def flag_share(
    df: DataFrame, key: str, flag: Column, out: str, keep_zero: bool = False
) -> DataFrame:
    """Share of a key's rows on which ``flag`` holds; keys without any are dropped by default."""
    hits = F.count_if(flag)
    shares = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(hits.alias("_hits"), (hits / F.count("*")).alias(out))
    )
    return (shares if keep_zero else shares.where("_hits > 0")).drop("_hits")


def any_true(df: DataFrame, key: str, flag: Column, out: str) -> DataFrame:
    """Whether ``flag`` holds on any row of the key; null counts as false."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.coalesce(F.bool_or(flag), F.lit(False)).alias(out))
    )


def shannon(category: str, n: str) -> Column:
    """Shannon index over pre-counted (key, category) rows, as one aggregate per key.

    ``|sum p ln p|`` with ``p = n / total``; the null category counts in the total only.
    Written out as ``sum(n ln n) / total - sum(n) ln(total) / total`` it needs neither a join
    nor a window for the total.
    """
    total = F.sum(n)
    known = F.when(F.col(category).isNotNull(), F.col(n))
    return F.abs((F.sum(known * F.ln(known)) - F.sum(known) * F.ln(total)) / total)


def shannon_index(df: DataFrame, key: str, category: str, out: str) -> DataFrame:
    """Shannon index of the categories per key; keys with only null categories are dropped."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key, category)
        .agg(F.count("*").alias("_n"))
        .groupBy(key)
        .agg(shannon(category, "_n").alias(out))
        .where(F.col(out).isNotNull())
    )


def last_non_null(df: DataFrame, key: str, value: str, order: list[str], out: str) -> DataFrame:
    """Per key the value of the last row, in ``order``, whose value is neither null nor NaN.

    A key without such a row has a null. One row per key is left before the shuffle.
    """
    known = F.when(~F.isnan(value), F.col(value)) if _is_float(df, value) else F.col(value)
    rows = df.withColumn(out, known)
    last_first = [F.col(out).isNull(), *[F.col(c).desc() for c in order]]
    return first_per_key(rows, [key], last_first).select(key, out)


def _is_float(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() in ("double", "float")


def firm_rollup(
    df: DataFrame,
    key: str,
    order: list[str],
    first: list[str] = (),
    mean: list[str] = (),
    any_of: list[str] = (),
    total: list[str] = (),
) -> DataFrame:
    """Declared roll-up: first non-null value in ``order``, mean, OR and sum per key.

    Means, flags and sums are one hash aggregate; each first value is limited to a row per key before
    its shuffle and joined by key.
    """
    rows = df.where(F.col(key).isNotNull())
    sums = [F.avg(c).alias(c) for c in mean]
    sums += [F.max(c).alias(c) for c in any_of] + [F.sum(c).alias(c) for c in total]
    out = rows.groupBy(key).agg(*sums) if sums else rows.select(key).distinct()
    for c in first:
        known = rows.where(F.col(c).isNotNull()).select(*dict.fromkeys([key, c, *order]))
        out = out.join(first_per_key(known, [key], order).select(key, c), key, "left")
    return out.select(key, *first, *mean, *any_of, *total)
