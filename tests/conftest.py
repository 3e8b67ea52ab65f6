import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seekframe import Catalog, configure, shared_dir  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="seekframe-tests-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def catalog(spark):
    return Catalog(spark, shared_dir(spark))


# The searched names of the user fixture, on which the golden orders depend; every
# other user is "Example <id>".
NAMED = {
    1: "Lara North",
    11: "Larry Casper",
    12: "Reta Larkin",
    20: "Prof. Larry Prosacco DVM",
    39: "Linkwood Larkin",
    40: "Otis Larson MD",
    41: "Gudrun Larkin",
    42: "Dax Larkin",
    43: "Dana Larson Sr.",
    44: "Amos Larson Sr.",
}
UNVERIFIED = {11, *range(20, 40)}


@pytest.fixture(scope="session")
def users(spark):
    rows = [
        (i, NAMED.get(i, f"Example {i}"), f"{i}@{'un' if i in UNVERIFIED else ''}verified.test", 25)
        for i in range(1, 45)
    ]
    return spark.createDataFrame(rows, "id INT, name STRING, email STRING, age INT")
