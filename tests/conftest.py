import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session
    s = local_session("*", shuffle_partitions=8, driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tidemark-test-")


SF_SMALL = "/root/testdata/sf0.001"
