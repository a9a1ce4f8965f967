import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from metricwatch.session import checkpoint_dir, local_session
    s = local_session(4, shuffle_partitions=4, app="metricwatch-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="metricwatch-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="metricwatch-test-")
