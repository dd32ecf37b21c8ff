import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def final_plan(df):
    """The physical plan after running the frame, initial plans left out."""
    df.collect()
    modes = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    text = df._jdf.queryExecution().explainString(modes.fromString("simple"))
    kept, hidden_from = [], None
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if hidden_from is not None and depth >= hidden_from:
            continue
        hidden_from = depth if "== Initial Plan ==" in line else None
        if hidden_from is None:
            kept.append(line)
    return "\n".join(kept)
