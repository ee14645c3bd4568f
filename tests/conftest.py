import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    # Use the shared folder the environment names; only where none is set,
    # give the (local) test session its own.
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-test-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def cfg():
    from strata.config import PINNED
    return PINNED
