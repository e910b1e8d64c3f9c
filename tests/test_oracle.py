"""Every registered query against its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as entry
import oracle

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    return oracle.database(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert oracle.compare(df, db, sql) is None


def test_entry(spark):
    assert entry.entry(spark).columns[-1] == "rank"


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
