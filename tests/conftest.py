from __future__ import annotations

import os
import sys
import tempfile
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from visitmart.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="visitmart-test-", dir="/tmp")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": f"{folder}/shared",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows_of(frame) -> list[tuple]:
    """Rows as tuples in a fixed order."""
    return sorted((tuple(row) for row in frame.collect()), key=lambda row: [(v is None, str(v)) for v in row])
