import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidepool.session import build_session

    warehouse = tempfile.mkdtemp(prefix="tidepool-test-warehouse-")
    s = build_session(4, app="tidepool-tests", shuffle_partitions=4, driver_memory="8g",
                      extra={"spark.sql.warehouse.dir": warehouse})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidepool-test-ckpt-"))
    yield s
    SparkSession.getActiveSession() and s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return tmp_path
