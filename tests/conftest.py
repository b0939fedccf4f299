import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tidepool.session import build_session, shared_dir
    s = build_session("local[*]", "tidepool-tests", 8)
    shared_dir(s)   # the session's spark.checkpoint.dir; a temporary one only if it is unset
    yield s
    s.stop()


@pytest.fixture
def workdir(spark):
    from tidepool.session import scratch_path
    return scratch_path(spark, "tests")
