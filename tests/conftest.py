import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from equitylake.session import get_session  # noqa: E402
from equitylake.sources.store import Store  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[4]", app_name="equitylake-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
