import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A plain session, as somebody else would hand it over: none of the package's settings.
    from pyspark.sql import SparkSession
    from turnwise.session import prepare
    session = (SparkSession.builder.master("local[4]").appName("turnwise-tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g")
               .config("spark.ui.enabled", "false").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
