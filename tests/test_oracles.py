"""Every registered query against its SQL, on the smallest given tables."""

import pytest

import __spark_entry__ as contract
from check import connect, difference
from registry.oracles import ORACLES
from registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ours = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(ours, con.execute(ORACLES[name]).df()) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
