import pytest

from hazardmart.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "hazardmart-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
