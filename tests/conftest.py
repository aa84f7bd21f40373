from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMOKE = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from silverline.session import build_session

    session = build_session(master="local[4]", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def workdir(tmp_path):
    return tmp_path
