import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from topiclake.session import get_spark
    s = get_spark("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def fx(spark):
    from topiclake.sources import fixtures
    return fixtures.fixture(spark, SF_SMALL)


@pytest.fixture()
def scratch():
    """A fresh local folder per test (tests only; jobs use the shared folder)."""
    return tempfile.mkdtemp(prefix="topiclake-test-")
