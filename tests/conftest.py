import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import checkpoint_dir, get_session
    s = get_session("tidemark-tests", master="local[4]", shuffle_partitions=4,
                    conf={"spark.driver.memory": "8g",
                          "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-wh-"),
                          # set here only because tests have no cluster setting
                          "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="run-")
