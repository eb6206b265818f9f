"""Table sources: parquet folders, JDBC tables and SQL over them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from boardlens.session import local_folder, ship

#: The file of a stage that names its whole version.
CURRENT = "_current"


def read_tables(spark: SparkSession, root: str, *names: str) -> list[DataFrame]:
    """One lazily scanned DataFrame per ``<root>/<name>.parquet``."""
    return [spark.read.parquet(f"{root}/{name}.parquet") for name in names]


def pull(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Result of a SQL text in which ``{name}`` stands for a DataFrame."""
    return spark.sql(sql, **tables)


def attach(spark: SparkSession, table: str, path: str, source: str = "parquet") -> None:
    """Make files known as ``schema.table``, so that SQL texts may name them like a warehouse."""
    if "." in table:
        spark.sql("CREATE NAMESPACE IF NOT EXISTS IDENTIFIER(:s)", {"s": table.rsplit(".", 1)[0]})
    spark.catalog.createTable(table, path=path, source=source)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A warehouse table read by ``partitions`` range queries; filters are pushed down."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
            **options,
        )
        .load()
    )


def scratch(spark: SparkSession) -> str:
    """A fresh path below the shared folder in ``spark.checkpoint.dir``.

    Only a local session may leave the setting out; it gets a folder that goes when the process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = local_folder()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def snapshot(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write once, read back with the same types; cuts the lineage. Without a path into ``scratch``.

    What lies at ``path`` stays until the new rows are whole, so ``df`` may read it.
    """
    ship(df.sparkSession)
    if path is None:
        path = scratch(df.sparkSession)
        df.write.parquet(path)
    else:
        replace_folder(df, path, lambda rows, folder: rows.write.parquet(folder))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Store the rows as the current version of the stage at ``path`` and read it, as ``read_stage`` does.

    Each write gets a folder of its own, and one rename of a small file makes it current once it is
    whole: a write that fails leaves the version before as it was, and ``df`` may read the very stage
    it replaces. The version before stays for jobs that still read it; older ones and what failed
    writes left are removed. One writer at a time.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = _manifest(spark, path)
    name = f"v{int(before['version'][1:].partition('-')[0]) + 1 if before else 1}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    draft = f"{path}/{CURRENT}.{uuid.uuid4().hex}"
    fs = _files(spark, path)
    out = fs.create(_path(spark, draft))
    try:
        out.write(bytearray(json.dumps({"version": name, "schema": df.schema.jsonValue()}).encode()))
    finally:
        out.close()
    rename(spark, draft, f"{path}/{CURRENT}")
    for old in fs.listStatus(_path(spark, path)):
        if old.isDirectory() and old.getPath().getName() not in (name, before and before["version"]):
            fs.delete(old.getPath(), True)
    return read_stage(spark, path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a stage, with the types it was written with."""
    path = path.rstrip("/")
    manifest = _manifest(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"no stage at {path}")
    return spark.read.schema(StructType.fromJson(manifest["schema"])).parquet(f"{path}/{manifest['version']}")


def _manifest(spark: SparkSession, path: str) -> dict | None:
    own, fs = _path(spark, f"{path}/{CURRENT}"), _files(spark, path)
    if not fs.exists(own):
        return None
    stream = fs.open(own)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def replace_folder(df: DataFrame, path: str, write) -> None:
    """``write(df, folder)`` into a folder beside ``path`` that takes its place once it is whole.

    For files that others read by their plain path. A write that fails leaves the old files.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    head, _, tail = path.rpartition("/")
    beside = f"{head}/.{tail}-{uuid.uuid4().hex}"
    fs = _files(spark, path)
    try:
        write(df, f"{beside}/new")
        if fs.exists(_path(spark, path)):
            rename(spark, path, f"{beside}/old")
        rename(spark, f"{beside}/new", path)
    finally:
        fs.delete(_path(spark, beside), True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """One file or folder takes another name; a file of that name is replaced in the same step."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    hadoop = jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(_files(spark, old).getUri(), _conf(spark))
    options = gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context.rename(_path(spark, old), _path(spark, new), options)


def _conf(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(_conf(spark))


def together(spark: SparkSession, *steps: Callable[[], DataFrame]) -> list[DataFrame]:
    """Results of independent steps whose jobs share the cores: one fills what the last tasks of another leave idle.

    All have ended before a failure of one surfaces.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        inherit = inheritable_thread_target(spark)
        running = [pool.submit(inherit(step)) for step in steps]
    return [step.result() for step in running]


def drop_snapshots(*tables: DataFrame) -> None:
    """Delete the folders of snapshots that no later plan reads."""
    for df in tables:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = _path(df.sparkSession, folder)
            path.getFileSystem(_conf(df.sparkSession)).delete(path, True)
