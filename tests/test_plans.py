"""Plan-shape checks for the registered queries (streams and models run their jobs while they are built): the scale rules hold in the physical plans, not just in the
results (no cross or nested-loop joins, no whole-group collection, filters reach the Parquet scan, the as-of join
shuffles and sorts its full rows once)."""

import re

import pytest

from tests.conftest import SF_SMALL

import __spark_entry__ as E

def _batch_queries():
    from ledgerlens.plans.registry import load_all
    return sorted(load_all()[0])


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", _batch_queries())
def test_no_cross_join_or_whole_group_buffer(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"\bcollect_list\(", plan)


def test_filters_reach_the_scan(spark):
    plan = _plan(E.queries()["point_in_time_join"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in plan


def test_asof_join_sorts_full_rows_once(spark):
    plan = _plan(E.queries()["point_in_time_join"](spark, SF_SMALL))
    # windows: the per-(key, bucket) running window and the per-key window over bucket summaries, nothing else
    assert plan.count("Window [") == 2
    # the per-key window's input is the summary aggregate, not the union of all rows
    assert re.search(r"Window \[.*_p0.*\n(.*\n)*?.*Aggregate", plan)
