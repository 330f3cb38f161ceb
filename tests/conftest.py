"""One Spark session for all tests; its event log goes to a fresh folder."""

from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from faregate.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def event_dir(tmp_path_factory):
    return str(tmp_path_factory.mktemp("events"))


@pytest.fixture(scope="session")
def spark(event_dir):
    session = build_session(
        master="local[4]",
        event_dir=event_dir,
        extra={"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / "out")
