import pytest

from reviewloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny_limits(monkeypatch):
    """Takes the way for large tables even on small ones."""
    from reviewloom.plans import limits

    monkeypatch.setattr(limits, "SMALL_ROWS", 1)
    monkeypatch.setattr(limits, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(limits, "HOT_SHARE", 4)
