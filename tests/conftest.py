from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from boardlens.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--master local[8] pyspark-shell")
    session = build("tests", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
