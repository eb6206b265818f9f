"""From a wide table to a model frame: complete rows, label index, scaling, weights, split."""

from __future__ import annotations

from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardlens.sources.tables import snapshot


def complete_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows without a null (or NaN) in any column, or in ``subset``."""
    return df.na.drop("any", subset=subset)


def fit_labels(df: DataFrame, label: str, out: str) -> StringIndexerModel:
    """Label index in alphabetical order; the number of classes bounds what is kept."""
    return StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc").fit(df)


def labels_back(model: StringIndexerModel, index: str, out: str) -> IndexToString:
    return IndexToString(inputCol=index, outputCol=out, labels=model.labels)


def one_hot(df: DataFrame, col: str, out: str) -> DataFrame:
    """Sparse indicator vector with one slot per distinct value, in order; null and NaN are errors.

    The number of values is the length of the vector, so it is meant for few of them.
    """
    index = f"_{col}_index"
    indexed = fit_labels(df, col, index).transform(df)
    encoder = OneHotEncoder(inputCols=[index], outputCols=[out], dropLast=False)
    return encoder.fit(indexed).transform(indexed).drop(index)


def indicator_slots(df: DataFrame, col: str, out: str) -> DataFrame:
    """``df`` with the slot (from 0, in order) that an indicator vector of ``col`` would set.

    For any number of values: distinct ones are range-sorted, written and numbered part by part, and
    the slots are joined; nothing comes to the driver but a count per part. Null has no slot.
    """
    values = snapshot(
        df.select(F.col(col).alias("_value"))
        .where(F.col(col).isNotNull())
        .distinct()
        .repartitionByRange("_value")
        .withColumn("_part", F.spark_partition_id())
    )
    sizes = values.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy("_value"))
    slots = values.withColumn("_own", own).join(starts, "_part").select("_value", (F.col("_start") + F.col("_own") - 1).alias(out))
    return df.join(slots, F.col(col) == F.col("_value"), "left").select(*df.columns, out)


def argmax(values: Column) -> Column:
    """Position (from 0) of the largest element of an array, the first on ties."""
    return F.array_position(values, F.array_max(values)).cast("int") - 1


def standardise(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Subtract the mean and divide by the population deviation; constant columns become 0.

    The moments come from one aggregate, read back as a one-row scalar subquery.
    """
    source = df if fit_on is None else fit_on
    moments = source.agg(
        F.struct(
            *[F.avg(F.col(c).cast("double")).alias(f"{c}_mean") for c in cols],
            *[F.stddev_pop(F.col(c).cast("double")).alias(f"{c}_std") for c in cols],
        ).alias("_moments")
    )

    def scaled(c: str) -> Column:
        mean, std = F.col(f"_moments.{c}_mean"), F.col(f"_moments.{c}_std")
        return F.when(std == 0, F.lit(0.0)).otherwise((F.col(c).cast("double") - mean) / std)

    return (
        df.withColumn("_moments", moments.scalar())
        .withColumns({c: scaled(c) for c in cols})
        .drop("_moments")
    )


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight ``n / (classes * class count)`` per row, as the last column; null labels have none.

    Class counts are joined, however many there are; Spark broadcasts them if they are small.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_n"))
    totals = counts.agg(F.struct(F.sum("_n").alias("n"), F.count("*").alias("k")))
    weights = counts.withColumn("_t", totals.scalar()).select(
        "_label", (F.col("_t.n") / (F.col("_t.k") * F.col("_n"))).alias(out)
    )
    return df.join(weights, F.col(label) == F.col("_label"), "left").select(*df.columns, out)


def explicit_weights(
    df: DataFrame, label: str, weights: dict, default: float | None = 1.0, out: str = "weight"
) -> DataFrame:
    """Weight per row from a given label-to-weight mapping."""
    if not weights:
        return df.withColumn(out, F.lit(default).cast("double"))
    pairs = [F.lit(v) for k, w in weights.items() for v in (k, float(w))]
    found = F.try_element_at(F.create_map(*pairs), F.col(label))
    return df.withColumn(out, F.coalesce(found, F.lit(default).cast("double")))


def split_bucket(key: str, seed: int | Column) -> Column:
    """0 to 99 from the md5 of key and seed; the same on every run and partitioning."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit("#"), seed.cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100).cast("int")


def hash_split(
    df: DataFrame, key: str, seed: int = 42, test_percent: int = 20
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by the hash of the key, without a shuffle; rows without a key train."""
    test = in_test(key, seed, test_percent)
    return df.where(~test), df.where(test)


def in_test(key: str, seed: int | Column = 42, test_percent: int = 20) -> Column:
    """Whether a row is held out; the seed may be a column."""
    return F.coalesce(split_bucket(key, seed) < test_percent, F.lit(False))


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)
