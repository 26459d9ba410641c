from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from kickflow.session import build

    base = tmp_path_factory.mktemp("spark")
    session = build(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def replies(spark):
    """Reply rows out of ``(key, status, body)``."""

    def make(*rows, ds="2023-08-02"):
        return spark.createDataFrame(
            [(key, ds, status, body) for key, status, body in rows],
            "key STRING, ds STRING, status_code INT, body STRING",
        )

    return make


@pytest.fixture
def database(spark):
    from kickflow.queries import _database

    return _database(spark, "test")
