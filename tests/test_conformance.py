"""Every registered query against its SQL on the smallest data."""

import pytest

from conformance.compare import connect, difference
from conformance.oracle import oracle_sql
from conformance.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ORACLE = oracle_sql()
ROWS_ONLY = {"assign_ids"}


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY and set(ORACLE) <= set(QUERIES)


def _check_plan(name, df):
    """No Python, no cross join, nothing whole in one task."""
    text = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
        assert operator not in text
    assert "SinglePartition" not in text or name.endswith("_summary")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    _check_plan(name, df)
    rows, problem = difference(df, db, ORACLE[name])
    assert problem is None and rows > 0


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_without_sql_gives_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    _check_plan(name, df)
    assert df.count() > 0
