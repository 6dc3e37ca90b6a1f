import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shoppulse.session import build_session

    ckpt = tempfile.mkdtemp(prefix="shoppulse-test-ckpt-")
    warehouse = tempfile.mkdtemp(prefix="shoppulse-test-wh-")
    session = build_session(
        "local[8]",
        shuffle_partitions=8,
        checkpoint_dir=ckpt,
        extra_conf={"spark.sql.warehouse.dir": warehouse},
    )
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="shoppulse-test-")
