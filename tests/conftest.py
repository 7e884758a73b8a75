import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quern.session import get_session
    ck = tempfile.mkdtemp(prefix="quern-test-ck-")
    s = get_session("local[4]", app="quern-tests",
                    conf={"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": ck})
    yield s
    s.stop()
