"""CSV with header and explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from boardlens.operators.rows import union_all
from boardlens.schemas import RANKINGS
from boardlens.sources.tables import replace_folder

# The ranking years and their file name.
RANKING_YEARS = range(2011, 2025)
RANKING_FILE = "{year}_rankings.csv"


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Columns of ``schema`` by header name, whatever else the files hold and in whatever order.

    The header of each path is read first (files below one path share theirs); several paths are
    read one by one and united. A name that a header lacks fails.
    """
    return union_all([_by_name(spark, p, schema) for p in ([path] if isinstance(path, str) else path)])


def _by_name(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    header = spark.read.csv(path, header=True, escape='"').columns
    kinds = {f.name: f.dataType for f in schema}
    own = StructType([StructField(name, kinds.get(name, StringType())) for name in header])
    return spark.read.schema(own).csv(path, header=True, escape='"').select(*schema.names)


def write_csv(df: DataFrame, path: str) -> None:
    """Files with a header below ``path``; old ones go once the new ones are whole."""
    replace_folder(df, path, lambda rows, folder: rows.write.csv(folder, header=True, escape='"'))


def read_rankings(spark: SparkSession, root: str, years=RANKING_YEARS) -> DataFrame:
    """All yearly ranking files with the year of each row's file.

    The three used columns are taken by the header of each file, which may hold others.
    """
    return union_all(
        [
            read_csv(spark, f"{root}/{RANKING_FILE.format(year=y)}", RANKINGS).withColumn("year", F.lit(y))
            for y in years
        ]
    )
