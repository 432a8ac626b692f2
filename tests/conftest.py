import os
import sys
import tempfile

import pytest

# Before numpy loads: in this process its BLAS threads hang in linalg.inv (op13)
# after the tests of other operators. Spark's Python workers have one thread, too.
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corvid.session import local_session

    scratch = tempfile.mkdtemp(prefix="run-test-", dir="/tmp")
    s = local_session(cpus="*", shuffle_partitions=8, checkpoint_dir=os.path.join(scratch, "ckpt"))
    yield s
    s.stop()


def fixture(name: str) -> str:
    return os.path.join(FIXTURES, name)
