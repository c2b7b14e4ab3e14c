import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sievewright.session import AT_START, RUNTIME  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RUNTIME, **AT_START}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """A one-column table ``c`` of the given texts and a function that evaluates expressions on it."""
    def run(values, *exprs):
        df = spark.createDataFrame([(v,) for v in values], "c string")
        return [tuple(r) for r in df.select(*exprs).collect()]

    return run
