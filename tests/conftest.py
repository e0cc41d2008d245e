import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketloom.session import local_session

    session = local_session("4", 4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in sorted(os.listdir(SMALL)):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SMALL}/{file}'")
    return con
