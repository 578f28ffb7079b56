"""Every registered query against its SQL, at the smallest scale."""

import pytest

from oracle import compare, connect
from sparkmart.workload import REGISTRY
from sparkmart.workload.base import DRIVER_TABLES, ROLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_agrees_with_sql(spark, duck, name):
    q = REGISTRY[name]
    df = q(spark, SF)
    # nothing crosses two tables; scalar subqueries are the only unkeyed inputs
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if q.sql is None:
        assert df.count() >= 0
    else:
        assert compare(df, duck, q.sql) is None


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(callable(q) for q in entry.queries().values())


def test_roles_use_given_tables():
    import re

    for text in ROLES.values():
        used = set(re.findall(r"\{([a-z]\w*)\}", text))
        assert used and used <= set(DRIVER_TABLES)
