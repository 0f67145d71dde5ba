import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripmart.session import build_session

    session = build_session(master="local[*]", app="tripmart-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def lake(spark):
    from tripmart.session import scratch_path
    from tripmart.sources.lake import Lake

    return Lake(scratch_path(spark, "test-lake"))
