import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import checkpoint_dir, get_spark
    s = get_spark(4, shuffle_partitions=8)
    checkpoint_dir(s)          # local scratch folder only because none is configured
    yield s
    s.stop()


SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
