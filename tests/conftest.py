import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import build_session
    s = build_session(master="local[4]", app="ledgerlake-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    """A fresh scratch folder per test (pytest's tmp_path is unique per test)."""
    return str(tmp_path)
