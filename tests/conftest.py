import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("weblode-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply a Column function to Python strings, in order."""

    def apply(function, inputs):
        from pyspark.sql import functions as F

        rows = [(i, text) for i, text in enumerate(inputs)]
        df = spark.createDataFrame(rows, "i int, text string")
        out = df.select("i", function(F.col("text")).alias("out")).orderBy("i")
        return [row["out"] for row in out.collect()]

    return apply


SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
