import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from gaugeworks.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, app="gaugeworks-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
