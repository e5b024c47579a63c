import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewright.session import local_session

    return local_session(8)


@pytest.fixture(scope="session")
def duck():
    import glob

    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.fixture(scope="session")
def sf():
    return SF
