"""Every registered query of the engine against its SQL, on the smallest tables."""

import pytest

import __spark_entry__
from loomseq import plans
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    same(plans.QUERIES[name](spark, SF).toPandas(), duck.execute(plans.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    df = plans.QUERIES[name](spark, SF)
    assert df.count() > 0
    assert len(df.columns) == len(set(df.columns))


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
