import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tenderlake.session import build_session
    scratch = tempfile.mkdtemp(prefix="tenderlake-tests-")
    s = build_session("local[*]", "tenderlake-tests", shuffle_partitions=8,
                      conf={"spark.checkpoint.dir": f"{scratch}/ckpt"})
    yield s
    from tenderlake.session import drop_scratch
    drop_scratch(s)
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tenderlake-t-")
