"""Every query of the catalog against the same query in DuckDB."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from shopgauge.plans.catalog import QUERIES
from shopgauge.plans.oracle import ORACLES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).count() == 3
