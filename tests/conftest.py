import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from squall.session import get_session
    ckpt = tempfile.mkdtemp(prefix="squall-test-ckpt-")
    s = get_session("local[4]", app_name="squall-tests", shuffle_partitions=4,
                    extra_conf={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def earlier_streams_forgotten(request):
    """Spark remembers queries that other tests let fail, and would raise their
    errors in the next wait for any query."""
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").streams.resetTerminated()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="squall-test-")
