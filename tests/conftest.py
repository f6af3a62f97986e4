import os
import sys
from datetime import datetime, timezone
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millwright import contracts as c  # noqa: E402
from millwright.session import builder  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        builder("tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.maxMetadataStringLength", "2000")  # plans are read by tests
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def event(**values) -> dict:
    row = {f.name: None for f in c.LOGISTICS_EVENTS.fields}
    row.update(
        event_id=1, event_timestamp=utc("2025-02-01T10:00:00"), asset_id="A",
        ingested_at=utc("2025-02-01T11:00:00"),
    )
    row.update(values)
    return row


def reading(**values) -> dict:
    row = {f.name: None for f in c.HRSS_TELEMETRY.fields}
    row.update({f"{axis}_power_w": 10 for axis in c.AXES})
    row.update(
        reading_id=1, reading_timestamp=utc("2025-02-01T10:00:00"), label=0,
        cycle_elapsed_sec=Decimal("1.5"), is_anomalous=False, is_optimised=False,
        ingested_at=utc("2025-02-01T11:00:00"),
    )
    row.update(values)
    return row


@pytest.fixture
def events(spark):
    return lambda rows: spark.createDataFrame([event(**r) for r in rows], c.LOGISTICS_EVENTS)


@pytest.fixture
def readings(spark):
    return lambda rows: spark.createDataFrame([reading(**r) for r in rows], c.HRSS_TELEMETRY)
