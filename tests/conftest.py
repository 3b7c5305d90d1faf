import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opsmetrics.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(folder / "checkpoint"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
