import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakemart.session import build_session
    s = build_session("local[*]", 8)
    if not s.conf.get("spark.checkpoint.dir", None):   # tests only: a private checkpoint folder
        d = tempfile.mkdtemp(prefix="lakemart-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()
