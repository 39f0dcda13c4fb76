import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from recspark.session import spark_session
    s = spark_session("recspark-tests", master="local[4]", shuffle_partitions=4,
                      conf={"spark.driver.memory": "4g"})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
