from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stopwise.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "stopwise-tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def set_option(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_option
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
