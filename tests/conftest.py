import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import local_session, scratch_dir  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=8, app_name="strata-tests")
    yield session
    session.stop()


@pytest.fixture()
def workdir(spark):
    """A fresh folder below the shared checkpoint root."""
    return scratch_dir(spark, "test")
