"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlens.session import ship
from boardlens.sources.tables import drop_snapshots, snapshot


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read again: lineage ends here.

    Lost executors cost at most the tasks since the last written table. Nothing is kept on one
    machine: the folder is below ``spark.checkpoint.dir``.
    """
    return snapshot(df)


def sized(df: DataFrame, rows: int, each: int = 10_000) -> DataFrame:
    """``df`` in a partition for ``each`` of about ``rows`` rows: at least one a core, never more than it has.

    Small tables then don't start a task and write a file for each of many shuffle partitions. A join's
    rows are those of its larger side, as both pass through its tasks.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def remove(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that no later plan reads."""
    drop_snapshots(*tables)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows no label may be learned from: crc32 of the id's text leaves 2 modulo 4.

    A null id is not held out; it can't match a label either.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


_TABLES: dict[str, dict] = {}


def process_table(owner: str) -> dict:
    """A table that outlives a task in its Python process; that of the owner before goes.

    Processes serve one operator after another, so at most one table is held in each.
    """
    if owner not in _TABLES:
        _TABLES.clear()
        _TABLES[owner] = {}
    return _TABLES[owner]


def map_rows(
    df: DataFrame,
    schema: str,
    start: Callable[[], Callable[["_Columns"], Iterable[pa.Array]]],
    keep: Iterable[str] = (),
) -> DataFrame:
    """Rows made from each Arrow batch.

    ``start`` runs once in each task and returns a function from the batch's columns to the new ones
    in the order of ``schema``; the columns in ``keep`` come first, as they are.
    """
    ship(df.sparkSession)
    keep = list(keep)
    kept = df.select(*keep).schema if keep else None
    names = [*keep, *(c.strip().split(" ")[0] for c in _top_level(schema))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_table("rows")
        make = start()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), *make(_Columns(batch))], names=names)

    full = schema if kept is None else ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields), schema]
    )
    return df.mapInArrow(run, full)


class _Columns:
    """Columns of a batch by name: texts and bytes one by one, so that a batch of them is held once; others as arrays."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.batch = batch

    def __getitem__(self, name: str):
        column = self.batch.column(name)
        one_by_one = pa.types.is_string(column.type) or pa.types.is_binary(column.type)
        return (value.as_py() for value in column) if one_by_one else column


def _top_level(schema: str) -> list[str]:
    parts, depth, last = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append(schema[last:i])
            last = i + 1
    return [*parts, schema[last:]]
