import uuid

import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tablecontract-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # A zone with daylight saving, so that nothing leans on the session being UTC.
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(root / "shared"))
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.sql.streaming.metricsEnabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def place(tmp_path):
    """A new table folder."""
    return str(tmp_path / f"t{uuid.uuid4().hex[:8]}")


@pytest.fixture
def table(spark):
    """Reads one of the given tables."""
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
