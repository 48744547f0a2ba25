import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from wattgrid.session import build_session, ensure_checkpoint_dir

    s = build_session("local[4]", app="wattgrid-tests", shuffle_partitions=4)
    # Tests only: a checkpoint folder of our own where the session names none.
    ensure_checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="wattgrid-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="wattgrid-test-", dir="/tmp")


def ts(s):
    import datetime as dt
    return dt.datetime.fromisoformat(s)
