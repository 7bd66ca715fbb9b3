import os

import pytest
from pyspark.sql import SparkSession

from tests.oracle import duckdb_tables

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    """Folder of the test tables; the queries are checked there against DuckDB."""
    return os.environ.get("TEST_SF_DIR", SF_SMALL)


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb_tables(sf_dir)
    yield connection
    connection.close()


@pytest.fixture
def table(spark):
    def read(name, sf=SF_SMALL):
        return spark.read.parquet(f"{sf}/{name}.parquet")

    return read
