import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.dirname(__file__))
os.environ.setdefault("OMP_NUM_THREADS", "1")

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cohortloom.session import build_session

    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
