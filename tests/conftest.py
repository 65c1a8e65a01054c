import pytest

from emberfold.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("emberfold-tests", cpus=4)
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
