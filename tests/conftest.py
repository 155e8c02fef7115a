import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from callcredit.session import build_session
    s = build_session("local[4]", 4, app_name="callcredit-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cc-tests-"))
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
