from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoreline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Make a frame from rows and a DDL schema; times may be given as text."""
    def make(rows, schema: str):
        names = [c.strip().split(" ")[0] for c in schema.split(",")]
        types = [c.strip().split(" ")[1] for c in schema.split(",")]
        text = ", ".join(
            f"`{n}` {'string' if t in ('timestamp', 'date') else t}" for n, t in zip(names, types)
        )
        df = spark.createDataFrame(rows, text)
        return df.selectExpr(*[f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in zip(names, types)])

    return make
