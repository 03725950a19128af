import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from yellowstar.session import build_session, ensure_checkpoint_dir

    session = build_session("local[4]", app_name="yellowstar-tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ys-test-")


@pytest.fixture(scope="session")
def trips_small(spark):
    from yellowstar.sources import trips_fixture

    return trips_fixture(spark, SF_SMALL)
