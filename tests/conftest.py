import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pixelchange.session import checkpoint_dir, local_session
    s = local_session("4", shuffle_partitions=4, app="pixelchange-tests",
                      checkpoints=tempfile.mkdtemp(prefix="pc-test-ckpt-"))
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="pc-test-store-")
