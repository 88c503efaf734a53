import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strata.session import checkpoint_dir, local_session

    s = local_session("*", 8, app="strata-tests")
    checkpoint_dir(s)
    yield s
    s.stop()
