"""Every registered query against its SQL."""

import pytest

from compare import connect, difference
from conftest import SMALL
from motefield.queries import REGISTRY


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, duck, name):
    query = REGISTRY[name]
    result = query.frame(spark, SMALL)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if query.sql is None:
        assert result.columns
    else:
        assert difference(result, duck, query.oracle()) is None
