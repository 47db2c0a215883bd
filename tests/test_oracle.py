"""Every registered query against its SQL oracle."""

import compare
import pytest

import __spark_entry__ as entry
from byteloom.plans import oracle, queries

SF = "/root/testdata/sf0.001"
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(queries.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_matches_oracle(spark, con, name):
    result = compare.spark_rows(queries.queries()[name](spark, SF))
    assert compare.difference(result, compare.oracle_rows(con, ORACLE[name])) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
