"""Each query against its SQL on the smallest test tables."""

import pytest

from parity import oracle_sql, spark_queries
from parity.compare import connect, differences

QUERIES, ORACLES = spark_queries.registry(), oracle_sql.registry()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == ""


def test_entry_returns_the_model(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.columns[0] == "camis" and len(df.columns) == 19 and df.count() > 0
