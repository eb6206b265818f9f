"""Text files of ``name: [v, v, ...]`` lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlens.operators.rows import union_all
from boardlens.operators.windows import first_per_key


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """(model, values) of each line plus the other columns of ``lines``."""
    parts = F.split(F.trim(F.col(value)), ": ", 2)
    return lines.withColumns(
        {
            "model": F.get(parts, F.lit(0)),
            "values": F.from_json(F.get(parts, F.lit(1)), "array<double>"),
        }
    ).drop(value)


def explode_runs(lists: DataFrame) -> DataFrame:
    """(model, run, accuracy), runs numbered from 0 in list order."""
    return lists.select("model", F.posexplode("values").alias("run", "accuracy"))


def read_run_lists(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Runs of all files; of two lines for one model the later file, then later line, counts."""
    files = [
        spark.read.text(path).select(
            "value",
            F.lit(i).alias("_file"),
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
        )
        for i, path in enumerate(paths)
    ]
    newest_first = [F.col(c).desc() for c in ("_file", "_path", "_block", "_line")]
    lists = parse_lines(union_all(files).where(F.trim("value") != ""))
    return explode_runs(first_per_key(lists, ["model"], newest_first))


def list_text(values: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(values.cast("array<string>"), ", "), F.lit("]"))


def format_run_lists(runs: DataFrame) -> DataFrame:
    """One ``value`` line per model, in run order. A line holds all runs of its model."""
    ordered = F.array_sort(F.collect_list(F.struct("run", "accuracy")))
    return (
        runs.groupBy("model")
        .agg(ordered.alias("_runs"))
        .select(
            F.concat(F.col("model"), F.lit(": "), list_text(F.col("_runs.accuracy"))).alias("value")
        )
    )


def write_run_lists(runs: DataFrame, path: str) -> None:
    format_run_lists(runs).write.mode("overwrite").text(path)
