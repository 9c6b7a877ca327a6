"""Queries of the training-data operators against DuckDB on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from same import check

from beadloom.llm import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_same_rows(spark, small, duck, name):
    check(catalogue.QUERIES[name](spark, small), duck.sql(catalogue.ORACLE[name]))


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_runs(spark, small, name):
    assert catalogue.QUERIES[name](spark, small).count() > 0


def test_the_core_does_not_import_this_package():
    import pathlib

    root = pathlib.Path(catalogue.__file__).parent.parent
    for p in root.rglob("*.py"):
        if p.parent.name != "llm":
            assert "beadloom.llm" not in p.read_text()
