"""Session settings the jobs expect."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from functools import cache

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


@cache
def local_folder() -> str:
    """A folder of this process that goes when it ends."""
    path = tempfile.mkdtemp(prefix="boardlens-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


@cache
def _package() -> str:
    """This package's source files as an archive that Python imports from."""
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(local_folder(), "boardlens.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, files in sorted(os.walk(root)):
            for name in sorted(files):
                if name.endswith(".py"):
                    own = os.path.join(folder, name)
                    archive.write(own, os.path.relpath(own, os.path.dirname(root)))
    return path


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that tasks can import it.

    Spark hands the archive to executors that join later, too. ``build`` and all stored tables call
    this; a session made elsewhere needs it only before Python work that stores nothing.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        context.addPyFile(_package())
        _SHIPPED.add(context.applicationId)


def build(app: str = "boardlens", **settings: str) -> SparkSession:
    """A session with UTC times and adaptive execution; ``settings`` override.

    On a cluster leave ``spark.sql.shuffle.partitions`` high: adaptive execution merges small
    partitions and splits skewed ones, but does not raise the number.
    """
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.appName(app)
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark
