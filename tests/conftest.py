import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from tillwise.session import get_session, checkpoint_dir
    s = get_session("local[*]", app="tillwise-tests", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s
