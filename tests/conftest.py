from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers have to find the package from any working folder.
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="tidemark-test-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{folder}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.driver.memory", "8g")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
