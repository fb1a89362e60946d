"""Every registered query against its SQL, on whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, duck_rows, spark_rows
from pricebeam.plans.registered import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, duck, name):
    assert spark_rows(queries()[name](spark, SF_DIR)) == duck_rows(duck, oracle_sql()[name])


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_own_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= queries().keys()
