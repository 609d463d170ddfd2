"""Plans of the llm queries: no products of tables, and no Python where DataFrame or SQL functions only are asked for."""

import pytest

from parcelwright.llm.queries import QUERIES

NATIVE = ("op3_", "op5_", "op7_", "op9_")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, data, name):
    plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name.startswith(NATIVE):
        assert "Arrow" not in plan and "Python" not in plan and "Pandas" not in plan
