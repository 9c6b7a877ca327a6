import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from beadloom.runtime import local_session

    return local_session(8, 8)


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    """DuckDB with the driver's tables as views."""
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SMALL}/{f}'")
    return con
