import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from hourglass.session import local_session

    folder = tempfile.mkdtemp(prefix="hourglass-tests-")
    s = local_session(4, shuffle_partitions=4, driver_memory="4g", extra_conf={
        "spark.checkpoint.dir": f"{folder}/checkpoints", "spark.sql.warehouse.dir": f"{folder}/warehouse"})
    yield s


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
