import pytest

from millrace.session import build
from tools.compare import database

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build("local[4]", 2)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    return database(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
