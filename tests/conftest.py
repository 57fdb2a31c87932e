import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("RIVULET_ORACLE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from rivulet.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "8g",
                             "spark.sql.streaming.noDataMicroBatches.enabled": "true"})
    yield s
    s.stop()
