import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clockroll.session import build_session
    extra = {}
    ckpt = os.environ.get("CLOCKROLL_TEST_CKPT") or tempfile.mkdtemp(prefix="run-", dir="/tmp")
    extra["spark.checkpoint.dir"] = ckpt
    s = build_session(master="local[4]", shuffle_partitions=4, extra=extra)
    yield s
