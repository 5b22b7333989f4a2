from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparksales import release_staged  # noqa: E402


@pytest.fixture(scope="session")
def event_folder(tmp_path_factory):
    return tmp_path_factory.mktemp("events")


@pytest.fixture(scope="session")
def staging(tmp_path_factory):
    return tmp_path_factory.mktemp("staging")


@pytest.fixture(scope="session")
def spark(event_folder, staging):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("sparksales-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{staging}")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", f"file://{event_folder}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_staged(session)
    session.stop()
