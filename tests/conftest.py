import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from worklake.session import build_session

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session("local[4]", shuffle_partitions=4, extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.exists(SF_SMALL):
        pytest.skip("test data not present")
    return SF_SMALL
