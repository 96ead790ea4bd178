import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from flightlake.session import local_session, shared_dir

    s = local_session("*", app="flightlake-tests")
    s.conf.set("spark.sql.shuffle.partitions", "8")
    shared_dir(s)
    yield s
    s.stop()


@pytest.fixture
def tmp_out(tmp_path):
    return str(tmp_path)
