"""Plans of joins and stages: nothing is crossed, large tables are read as often as needed."""

from __future__ import annotations

import pytest

from boardlens.plans.catalogue import QUERIES

ROOT = "/root/testdata/sf0.001"


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["latest_then_first", "firm_rollup", "lag_delta", "lag_rows", "ceo_background"])
def test_no_sort_aggregate(spark, name):
    assert "SortAggregate" not in executed(QUERIES[name](spark, ROOT))


@pytest.mark.parametrize("name", ["ceo_background", "fuzzy_best_match", "fuzzy_many_choices", "full_assembly"])
def test_no_cross_join(spark, name):
    plan = executed(QUERIES[name](spark, ROOT))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name,times", [("ceo_background", 0), ("full_assembly", 2)])
def test_scans_of_the_largest_table(spark, name, times):
    """Roles are read once into a stored table; the rest reads committees only."""
    plan = QUERIES[name](spark, ROOT)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet [l_") == times
