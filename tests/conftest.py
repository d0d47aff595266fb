import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vesselrisk.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="vesselrisk-tests")
    yield s
