import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from minekit.session import build_session, release_scratch  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app_name="minekit-tests", shuffle_partitions=8)
    yield s
    release_scratch(s)
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
