"""Every registered query against its check SQL on the smallest test data."""

import pytest

from lakeops.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
MAY_BE_EMPTY = {"flt2_predicates"}  # at this scale


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problems = [p for p in compare(spark, con, name, SF_DIR) if name not in MAY_BE_EMPTY or p != "both results are empty"]
    assert not problems


def test_every_query_has_check_sql():
    assert set(ORACLES) == set(QUERIES)


def test_no_row_caps_or_cross_joins(spark):
    """No plan multiplies rows of two tables or numbers raw rows in one task."""
    for name in ["jn7_asof_join", "jn9_event_transitions", "jn10_share_of_total", "c14_gold_order_lines", "tx1_prompts"]:
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
