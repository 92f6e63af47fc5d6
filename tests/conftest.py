import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from topicstream.session import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4)
    ship_package(session)
    yield session
    session.stop()
