import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from saleslens.session import get_session

    tmp = tempfile.mkdtemp(prefix="saleslens-test-")
    s = get_session("local[4]", app="saleslens-tests", shuffle_partitions=4, driver_memory="4g",
                    extra={"spark.sql.warehouse.dir": os.path.join(tmp, "warehouse")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
