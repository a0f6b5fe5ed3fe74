import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from orchard.session import checkpoint_dir, get_spark, ship_package
    s = get_spark(master="local[4]", partitions=8)
    checkpoint_dir(s)
    ship_package(s)
    yield s
