"""Row-level operators: conditional overwrite, union with precedence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlens.operators.windows import first_per_key


def overwrite_where(df: DataFrame, flag: Column, values: dict[str, object]) -> DataFrame:
    """Replace columns by constants on the rows where ``flag`` holds."""
    return df.withColumns(
        {
            name: F.when(flag, F.lit(value).cast(df.schema[name].dataType)).otherwise(F.col(name))
            for name, value in values.items()
        }
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every float column with NaN as null: what a missing number means in all operators here."""
    floats = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, frames)


def union_later_wins(frames: list[DataFrame], key: str) -> DataFrame:
    """Union with one row per key, taken from the last frame that has the key."""
    ranked = [df.withColumn("_source", F.lit(i)) for i, df in enumerate(frames)]
    return first_per_key(union_all(ranked), [key], [F.col("_source").desc()]).drop("_source")
