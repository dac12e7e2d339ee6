"""Every query against its SQL; queries without SQL must at least return rows."""

import pytest

import __spark_entry__ as entry_module
from compare import connect, mismatch

QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, sf_dir, duck, name):
    assert mismatch(QUERIES[name](spark, sf_dir).toPandas(), duck.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_returns_rows(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir).toPandas()
    assert len(frame) > 0
    assert frame.columns.is_unique


def test_entry_reads_the_smoke_tables(spark):
    frame = entry_module.entry(spark).toPandas()
    assert len(frame) == 200
    assert set(frame["confidence_tier"]) <= {"HIGH", "MEDIUM", "LOW"}
    assert frame["consecutive_blocked_rate"].between(0, 1).all()
