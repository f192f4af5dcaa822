import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratum.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("stratum-tests", cores="*", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    """A fresh scratch folder per test (never reused or cleared)."""
    return tempfile.mkdtemp(prefix="stratum-test-")
