"""Differential test: every registered query against its DuckDB oracle SQL
on the smallest driver tables (row count, columns, values)."""

import os

import pytest

import __spark_entry__ as e
from oracle_compare import compare, duck

SF = os.environ.get("LAYERTABLES_TEST_SF", "/root/testdata/sf0.001")
SQL = e.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    from layertables.plans.queries import QUERIES

    assert set(QUERIES) <= set(SQL) <= set(e.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = e.queries()[name](spark, SF)
    problems, n = compare(df, con, SQL[name])
    assert not problems, problems


def test_entry_runs(spark):
    df = e.entry(spark)
    assert df.columns == e.entry(spark).columns
    assert df.count() >= 0
