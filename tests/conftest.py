import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from eventmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session(
        "tests",
        master="local[8]",
        **{
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": f"{root}/warehouse",
            "spark.checkpoint.dir": f"{root}/shared",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def prefix():
    return f"t{os.urandom(5).hex()}_"


@pytest.fixture
def raw_table(prefix):
    return f"{prefix}raw.events"
