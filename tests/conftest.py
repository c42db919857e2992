from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from depotlens.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = get_spark(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(home / "warehouse"),
        spark__checkpoint__dir=str(home / "checkpoints"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
