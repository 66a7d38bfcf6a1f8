import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starloom.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="starloom-test-wh-")})
    # tests own the session, so they may name a checkpoint folder
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="starloom-test-")
