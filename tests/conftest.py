import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestar.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse, shared = (str(tmp_path_factory.mktemp(name)) for name in ("warehouse", "shared"))
    session = build_session(
        "lodestar-tests", master="local[4]",
        **{"spark.sql.shuffle.partitions": 4, "spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": shared, "spark.driver.memory": "6g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
