from __future__ import annotations

import os
import tempfile

import pytest

from panelcraft.session import build_session


def make_session():
    cores = os.environ.get("TEST_CPUS", "8")
    spark = build_session(
        "panelcraft-tests", f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.default.parallelism": "8", "spark.driver.memory": "12g",
            "spark.ui.enabled": "false", "spark.driver.bindAddress": "127.0.0.1", "spark.driver.host": "127.0.0.1",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="panelcraft-test-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
