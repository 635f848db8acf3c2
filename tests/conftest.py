import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparcel.session import local_session, tune  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", "6g")
    s.sparkContext.setLogLevel("ERROR")
    yield tune(s)
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
