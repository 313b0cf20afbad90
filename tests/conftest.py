import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from custlens.session import ensure_checkpoint_dir, get_session
    s = get_session("local[4]", 4, app="custlens-tests")
    if not s.sparkContext.getCheckpointDir():
        ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="custlens-test-ckpt-"))
    yield s
