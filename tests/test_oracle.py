"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from tests.oracle import assert_same_rows
from workload.oracles import oracle_sql
from workload.queries import queries

QUERIES = queries()
ORACLES = oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    assert_same_rows(QUERIES[name](spark, sf_dir), duck, ORACLES[name])


def test_entry_returns_known_differences(spark):
    row = driver.entry(spark).first()
    assert (row.only_in_source, row.only_in_sink, row.count_mismatch) == (32, 31, 14)
