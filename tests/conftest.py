import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pitwall.config import local_session

    # Tests set their own checkpoint folder only when the session has none.
    s = local_session("pitwall-tests", cores="*", partitions=8, checkpoint_dir=tempfile.mkdtemp(prefix="pw-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="pw-test-")
