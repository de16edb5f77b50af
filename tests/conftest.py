import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from essayspark.session import build_session

    s = build_session("local[4]", 8, app_name="essayspark-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="essayspark-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="essayspark-test-")
