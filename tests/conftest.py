import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session

    s = local_session("*", shuffle_partitions=8, app="tessera-tests")
    yield s
    s.stop()
