"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
import check
from ratebook.catalogue.registry import ORACLE, QUERIES

SF = f"{check.TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check.connect(SF)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    assert check.compare(spark, connection, SF, name) == ""
