from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallymark.session import build_session, shared_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_driver_memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    shared_folder(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
