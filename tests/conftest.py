from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from assayer.constants import BRONZE_SCHEMA  # noqa: E402
from assayer.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        # A task may fail once, as it may on a cluster.
        "local[8,2]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


GOOD_EVENT = {
    "event_id": "e1",
    "user_id": "u1",
    "session_id": "s1",
    "event_type": "purchase",
    "product_id": "PROD-1000",
    "product_name": "Thing",
    "category": "Books",
    "amount": 10.0,
    "currency": "USD",
    "quantity": 2,
    "email": "a@b.c",
    "ip_address": "192.168.1.1",
    "user_agent": "agent",
    "country": "DE",
    "event_ts": "2024-01-01T00:01:30",
    "ingested_at": "2024-01-01T00:05:00.123456",
}


@pytest.fixture(scope="session")
def bronze(spark):
    """Makes a Bronze DataFrame from changes to a good event, one row each."""

    def make(*changes: dict):
        rows = [{**GOOD_EVENT, **change} for change in changes]
        values = [tuple(row[n] for n in BRONZE_SCHEMA.names) for row in rows]
        return spark.createDataFrame(values, BRONZE_SCHEMA)

    return make
