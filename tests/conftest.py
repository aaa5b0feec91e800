from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import BROADCAST_BUDGET_CONF, build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ledgerline-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Make every lookup take the way for entries that are too large to broadcast, by us or by Spark's own choice."""
    spark.conf.set(BROADCAST_BUDGET_CONF, "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset(BROADCAST_BUDGET_CONF)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
