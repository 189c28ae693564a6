"""Shared local session."""

from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
# Python workers need the package too, whatever the working directory is.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def local_session() -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="touchtrail-tests-")
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("touchtrail-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return local_session()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR
