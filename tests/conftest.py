import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TEST_SF_DIR = os.environ.get("SIGSPARK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from sigspark.session import local_session

    session = local_session(cores="*", shuffle_partitions=8, driver_memory="8g", app_name="sigspark-tests")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sigspark-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TEST_SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    from tools.parity import duck as connect

    return connect(sf_dir)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="sigspark-test-")
