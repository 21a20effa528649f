import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorqc.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=8, app="sensorqc-tests",
                      extra={"spark.driver.memory": "4g"})
    # Tests set their own checkpoint folder only where the session has none.
    from sensorqc.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="sensorqc-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sensorqc-test-")
