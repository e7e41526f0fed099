import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roispark import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")), "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
