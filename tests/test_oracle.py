"""Every registered query against its SQL, on whole tables."""

import os

import oracle
import pytest

from swipelake import queries as registered

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query(spark, duck, name):
    df = registered.queries()[name](spark, SF)
    sql = registered.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert oracle.compare(df, duck, sql) is None


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
