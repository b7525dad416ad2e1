import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from streetpulse.session import build_session
    ckpt = tempfile.mkdtemp(prefix="streetpulse-test-ckpt-")
    s = build_session(master="local[4]", shuffle_partitions=4, app="streetpulse-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
