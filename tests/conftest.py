import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from batchwright.session import local_session, scratch_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("batchwright-tests", cores=4, shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def ws(spark):
    """A fresh scratch folder under the session's checkpoint folder."""
    return scratch_dir(spark, "test")


SF = "/root/testdata/sf0.001"
