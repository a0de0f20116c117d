import pytest

from sedimenta.session import local_session, tune
from tests.oracle import duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = tune(local_session("tests"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def con(sf):
    return duck(sf)


@pytest.fixture
def rows():
    """Sorted tuples of a frame's rows."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
