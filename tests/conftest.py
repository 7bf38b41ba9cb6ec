import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from ledgerline.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=8, app="ledgerline-tests")
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-ckpt-"))  # on a cluster: spark.checkpoint.dir
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="ledgerline-test-")
