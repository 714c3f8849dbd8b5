import pytest

from tests.oracle import connect
from tidemark.session import Tables, local_session

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    return connect(FOLDER)


@pytest.fixture(scope="session")
def t(spark):
    return Tables(spark, FOLDER)
