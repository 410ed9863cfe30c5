"""Every registered query against its SQL on the same files."""

import pytest

import __spark_entry__ as entry_module
import oracle

QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, sf_dir, name):
    assert oracle.compare(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    rows = entry_module.entry(spark).collect()
    assert rows and all(r["context"] is not None for r in rows)
