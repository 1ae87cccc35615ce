import pytest

from ledgerloom.runtime import clear, local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, "tests")
    yield s
    clear(s)
    s.stop()
