"""Every registered query against its SQL on the driver's tables."""

import os

import pytest
from compare import compare

import __spark_entry__ as contract
from shelfwise.oracle import ORACLE
from shelfwise.registry import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert contract.queries().keys() >= QUERIES.keys()
    assert contract.oracle_sql().keys() >= ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, name):
    rows = compare(spark, SF_DIR, contract.queries()[name], contract.oracle_sql()[name])
    assert rows > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
