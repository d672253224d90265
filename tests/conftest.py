import os
import sys

import duckdb
import pytest

for folder in (os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))):
    sys.path.insert(0, folder)

from cadenza.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for name in (
        "region nation customer supplier part orders lineitem events documents "
        "embeddings pages benchmark labels conversations"
    ).split():
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con
