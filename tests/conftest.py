"""One local session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from folioloom.session import build_session

    shared = tmp_path_factory.mktemp("checkpoints").as_uri()
    session = build_session("tests", 4, **{"spark.checkpoint.dir": shared, "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    yield session
    session.stop()
