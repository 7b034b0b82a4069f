import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("varstrata-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def edge(spark):
    """Frames of the shape k1, k2, x, note from rows of up to four fields."""

    def make(*rows):
        padded = [tuple(row) + ("",) * (4 - len(row)) for row in rows]
        return spark.createDataFrame(padded, "k1 string, k2 string, x string, note string")

    return make
