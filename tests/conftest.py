import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("SENSORFLOW_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from sensorflow.session import local_session
    shared = tempfile.mkdtemp(prefix="sensorflow-shared-")
    s = local_session(cpus="*", shuffle_partitions=8, app="sensorflow-tests",
                      conf={"spark.checkpoint.dir": f"file://{shared}"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from sensorflow.plans.compare import duck_connect
    return duck_connect(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
