import os
import tempfile

import pytest
from pyspark.sql import SparkSession

DATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("dockflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def run_dir():
    """A folder of its own for each test that writes."""
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.01"
