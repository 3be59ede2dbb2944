import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import local_session

    return local_session(cpus="4", shuffle_partitions=4, memory="4g", app="tests")


@pytest.fixture(scope="session")
def sf_dir():
    return SF
