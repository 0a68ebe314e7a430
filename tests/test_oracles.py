"""Every registered query against its SQL on the same tables."""

import pytest
from compare import assert_same
from helpers import plan_of

import __spark_entry__ as contract
from daytally.workload.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, name):
    result = contract.queries()[name](spark, SF)
    plan = plan_of(result)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    assert assert_same(result, contract.oracle_sql()[name], SF) > 0


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() == 15
    assert result.columns == ["user_id", "event_count", "total_value", "last_seen", "update_time"]
