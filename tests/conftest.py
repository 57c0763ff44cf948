import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from adspark.session import get_session
    scratch = tempfile.mkdtemp(prefix="adspark-tests-")
    # spark.checkpoint.dir is read from the session; get_session sets a private one only when unset.
    s = get_session(master="local[4]", app="adspark-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
                           "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="adspark-t-")
