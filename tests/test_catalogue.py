"""Every registered query against its SQL text on the smallest test data."""

from __future__ import annotations

import os

import pytest
from oracle import connect, differences

from boardlens.plans.catalogue import ORACLES, QUERIES

ROOT = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    with connect(ROOT) as con:
        yield con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    assert differences(db, ORACLES[name], QUERIES[name](spark, ROOT)) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, ROOT).count() > 0
