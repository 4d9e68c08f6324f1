import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a Column function over a list of strings."""
    from pyspark.sql import functions as F

    def run(function, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
        rows = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
        return [r["r"] for r in rows]

    return run


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def physical_plan():
    return plan_of
