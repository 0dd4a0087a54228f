"""Every registered query on the smallest tables: its physical plan, and its rows against the SQL text."""

import pytest

import __spark_entry__ as entry
import check_oracle
from reelweave import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check_oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    result = entry.queries()[name](spark, FOLDER)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert operator not in plan
    assert check_oracle.compare(spark, db, FOLDER, name, result) in ("", "no rows on either side")


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_text_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
