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
    from tidewater.session import get_session
    ckpt = tempfile.mkdtemp(prefix="tw-test-ckpt-")
    s = get_session("local[4]", app="tidewater-tests", shuffle_partitions=4,
                    extra={"spark.ui.showConsoleProgress": "false",
                           "spark.checkpoint.dir": ckpt,
                           "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tw-test-")
