"""Every registered query against its SQL oracle, and again without any broadcast join."""

import pytest

from checks.compare import difference, duck, duck_rows, spark_rows
from checks.oracle import oracle_sql
from checks.registry import queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, con, name):
    assert difference(spark_rows(QUERIES[name](spark, SF_DIR)), duck_rows(con, ORACLES[name])) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("q")])
def test_matches_oracle_without_broadcast(spark, con, no_broadcast, name):
    assert difference(spark_rows(QUERIES[name](spark, SF_DIR)), duck_rows(con, ORACLES[name])) is None


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
