from __future__ import annotations

import pytest

from storelens.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="6g", app="storelens-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
