from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tripmill.session import conf_set, get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


def at(text: str) -> dt.datetime:
    """A time on 2024-01-01, or a full ISO time."""
    return dt.datetime.fromisoformat(text if "-" in text else f"2024-01-01 {text}")


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df) -> str:
    """The physical plan with untruncated scan details."""
    with conf_set(df.sparkSession, spark__sql__maxMetadataStringLength="100000"):
        return df._jdf.queryExecution().executedPlan().toString()
