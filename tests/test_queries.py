"""Every catalogued query against its SQL, and the driver's contract without optional parts."""

import pytest

import __spark_entry__
from loamgrid import plans
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_matches_sql(spark, db, name):
    assert differences(plans.QUERIES[name](spark, SF), db, plans.ORACLE_SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
