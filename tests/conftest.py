import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pageops.session import build_session
    s = build_session("local[4]", app="pageops-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pageops-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    """Corpus folder for oracle and plan tests; PAGEOPS_TEST_SF overrides it
    (e.g. /root/testdata/sf0.01, the driver's correctness scale)."""
    return os.environ.get("PAGEOPS_TEST_SF", "/root/testdata/sf0.001")
