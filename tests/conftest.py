import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from nodecast.config import REQUIRED_COLUMNS
from nodecast.session import local_session

START = datetime(2021, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        "8",
        **{
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(folder),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


NODES = {"101": 3.0, "202": 11.0}
SIGNALS = [c for c in REQUIRED_COLUMNS if c not in ("node", "timestamp", "hour_utc", "day_of_week_utc")]


def reading(column: str, node: str, minute: int) -> float:
    """A straight line: its level tells column and node, its slope the column."""
    place = SIGNALS.index(column)
    return 100.0 * place + NODES[node] + 0.25 * (place + 1) * minute


def telemetry_rows(minutes=40):
    """Two nodes, one row a minute, every signal a line of its own."""
    return [
        {
            "node": node,
            "timestamp": START + timedelta(minutes=m),
            **{c: reading(c, node, m) for c in SIGNALS},
            "hour_utc": 0,
            "day_of_week_utc": START.weekday(),
        }
        for node in NODES
        for m in range(minutes)
    ]


SCHEMA = ", ".join(
    f"{c} "
    + {"node": "string", "timestamp": "timestamp", "hour_utc": "smallint",
       "day_of_week_utc": "tinyint"}.get(c, "double")
    for c in REQUIRED_COLUMNS
)


@pytest.fixture(scope="session")
def telemetry(spark):
    return spark.createDataFrame(
        [tuple(r[c] for c in REQUIRED_COLUMNS) for r in telemetry_rows()], SCHEMA
    ).cache()
