"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect
from rolepulse.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    result = compare(spark, con, name, sf_dir)
    assert result.startswith("ok"), result
