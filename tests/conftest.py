import os

import pytest
from pyspark.sql import SparkSession

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def one(spark):
    """Values of column expressions over one row of named values."""

    def evaluate(*columns, **values):
        schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'long'}" for k, v in values.items())
        row = spark.createDataFrame([tuple(values.values())], schema) if values else spark.range(1)
        got = row.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
        return got[0] if len(columns) == 1 else tuple(got)

    return evaluate
