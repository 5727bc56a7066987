import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from recengine.session import local_session
    s = local_session(4, shuffle_partitions=8, app="recengine-tests", driver_memory="4g")
    # tests run locally: the checkpoint folder is unset, so they set their own
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="recengine-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="recengine-test-")
