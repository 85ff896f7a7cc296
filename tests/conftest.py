from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]

from ebbtide.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # The zone is on purpose not UTC: no result may depend on it.
    session = local_session(
        8, 4, **{"spark.sql.session.timeZone": "America/New_York", "spark.sql.maxMetadataStringLength": "5000"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
