import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from parcelhouse.session import local_session

    session = local_session(cores=8, name="tests")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)
