import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eigenpool.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    folder = os.environ.get("EIGENPOOL_TEST_DATA", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    return folder
