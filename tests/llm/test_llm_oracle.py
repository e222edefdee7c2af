import oracle
import pytest

from swipelake.llm import queries as text

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(text.queries()))
def test_query(spark, name):
    df = text.queries()[name](spark, SMALL)
    sql = text.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert oracle.compare(df, oracle.connect(SMALL), sql) is None


def test_entry():
    import __spark_entry__ as contract

    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in contract.queries()}
    assert "pipeline" in contract.queries() and set(contract.oracle_sql()) <= set(contract.queries())
