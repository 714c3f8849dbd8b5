"""Every registered query: against its SQL, or, without one, that it gives rows of a stable schema."""

import pytest

import __spark_entry__ as entry
from tests.conftest import FOLDER
from tests.oracle import compare

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, duck):
    assert not compare(QUERIES[name](spark, FOLDER), duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(name, spark):
    df = QUERIES[name](spark, FOLDER)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
