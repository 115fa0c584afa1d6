import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from crease.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="crease-tests",
                      driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    # a fresh folder per test; never cleared by the tests themselves
    return tempfile.mkdtemp(prefix="crease-test-")


def rows(df, order=None):
    """Collect as sorted tuples (tests only)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out
