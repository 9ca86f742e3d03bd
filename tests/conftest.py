from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from murmura.session import local_session

    session = local_session("4", shuffle_partitions=4, memory="6g", spark_checkpoint_dir=f"file://{tmp_path_factory.mktemp('shared')}")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
