import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from auric.session import get_session

    s = get_session("local[4]", 8, app_name="auric-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="auric-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="auric-test-")
