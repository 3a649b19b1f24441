import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fleetlake.session import local_test_session
    s = local_test_session("4", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def tmp_root(spark):
    from fleetlake.session import scratch_path
    return scratch_path(spark, "test")
