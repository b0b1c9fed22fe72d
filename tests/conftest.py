import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from costmart.session import checkpoint_root, get_spark

    s = get_spark("costmart-tests", master="local[4]", shuffle_partitions=8)
    checkpoint_root(s)  # uses spark.checkpoint.dir when set, else registers a temp folder
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from costmart.session import scratch_path

    def make(name="t"):
        return scratch_path(spark, name)
    return make
