from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import tune

    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    path = TESTDATA / "sf0.001"
    if not path.exists():
        pytest.skip("no test data")
    return str(path)


@pytest.fixture(scope="session")
def duck(small_dir):
    import duckdb

    connection = duckdb.connect()
    connection.sql("set timezone = 'UTC'")
    for name in TABLES:
        connection.sql(f"create view {name} as from '{small_dir}/{name}.parquet'")
    return connection
