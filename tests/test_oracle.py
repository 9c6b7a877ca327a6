"""Every core query that SQL can express, against DuckDB on the smallest tables."""

import pytest

from beadloom.plans import expression_queries, general, molecule_queries, position_queries, profile_queries, sheet_queries

from same import check

MODULES = (general, molecule_queries, position_queries, sheet_queries, expression_queries, profile_queries)
QUERIES = {n: f for m in MODULES for n, f in m.QUERIES.items()}
ORACLE = {n: s for m in MODULES for n, s in m.ORACLE.items()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, small, duck, name):
    check(QUERIES[name](spark, small), duck.sql(ORACLE[name]))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).columns


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
