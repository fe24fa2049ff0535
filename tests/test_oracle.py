"""Every query against its SQL on the same tables."""

import pytest

import __spark_entry__ as entry
from compare import TESTDATA, connect, differences
from workload.oracle import all_oracle_sql
from workload.queries import all_queries

SF = "sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = connect(SF)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, con, name):
    result = entry.queries()[name](spark, str(TESTDATA / SF))
    assert differences(result, con, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
