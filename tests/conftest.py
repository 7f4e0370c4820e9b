import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from streamops.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="streamops-test-ckpt-")
    s = get_session("local[4]", shuffle_partitions=4, extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def con001():
    from tests.oracle import duck
    return duck(SF001)


@pytest.fixture(scope="session")
def con01():
    from tests.oracle import duck
    return duck(SF01)
