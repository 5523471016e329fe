import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from wearcast.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, driver_memory="8g")
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="wearcast-test-")
