import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def people(spark):
    from textquarry import Corpus, of_kind, text

    rows = [
        ("a", "Mira Of Saltmarsh", 30, "/people/staff"),
        ("b", "Tomas The Miller", 40, "/people/staff"),
        ("c", "Ines Stone", 25, "/people/freelance"),
    ]
    df = spark.createDataFrame(rows, "id string, name string, age long, category string")
    return Corpus(df, "id", {"name": text(), "category": of_kind("facet")})
