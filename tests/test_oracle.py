import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from caseline.plans.oracles import oracles
from caseline.plans.queries import QUERIES
from caseline.plans.specs import TABLES
from compare import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no analytics tables here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert difference(queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted([f"stage_{t.name}" for t in TABLES] + ["release_table"]))
def test_joins_keep_an_equality(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(oracles()) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
