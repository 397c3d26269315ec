import os
import sys
import tempfile
import time
from pathlib import Path

os.environ.setdefault("TZ", "UTC")
time.tzset()
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shopstream-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
