import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from firmlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    extra = {"spark.driver.memory": "8g",
             "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    if "SPARK_CHECKPOINT_DIR" in os.environ:
        extra["spark.checkpoint.dir"] = os.environ["SPARK_CHECKPOINT_DIR"]
    session = local_session(8, 8, "firmlens-tests", **extra)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
