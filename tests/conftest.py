import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from roadlens.session import build_session
    scratch = tempfile.mkdtemp(prefix="roadlens-test-")
    s = build_session("local[4]", app_name="roadlens-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                             "spark.local.dir": f"{scratch}/local",
                             "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="roadlens-case-")
