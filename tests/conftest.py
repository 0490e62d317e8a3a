import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session("local[4]", app="tidemark-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-test-ckpt-")})
    s.sparkContext.setCheckpointDir(s.conf.get("spark.checkpoint.dir"))
    yield s
    s.stop()


SF = os.environ.get("TIDEMARK_TEST_SF", "/root/testdata/sf0.001")
